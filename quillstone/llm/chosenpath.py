"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of word shingles. Documents with equal sets are one class. Class
representatives get 128 minwise values. A tree branches by chosen minwise coordinates: which
coordinates a node branches by is a function of its path, so every document works out its own
paths; two documents meet in a leaf if they agree along one of its paths. Independent trees are
repeated until a pair at the threshold meets with the target recall. Leaves are compared
exhaustively on 8-bit sketches of the minwise values, which yields candidate classes (connected by
estimated similarity, with a margin of four standard errors). The full sets are compared exactly:
first along one link a text, to a hub of its class, which settles most classes; in the others every
text outside the largest settled part is compared with all texts that it is not connected to, since
the result is components. Groups too large for one task are dealt out as pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .common import filter_words, forget, join_counted, materialize, may_be_among, partitions, table, units
from .components import components
from .texts import blobs, raw, slices

MINWISE = 128
BRANCHES = 2
RECALL = 0.9999
THRESHOLD = 0.8
#: Leaves are deep enough that unrelated documents, which share a minwise value with about this
#: probability, leave a leaf with about so many of them.
CHANCE, LEAF_ROWS = 0.05, 2000
#: Rows of a leaf, and texts of a candidate class (of each side of a pair of blocks), that one task takes at once.
LEAF_BLOCK, CLASS_BLOCK = 100_000, 48

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _RNG.integers(0, 1 << 63, MINWISE, dtype=np.uint64)
_STEP = _RNG.integers(0, 1 << 62, MINWISE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PLACE = _RNG.integers(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word in lower case, number of words up to the end of each text)."""
    n = len(data)
    lower = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    inside = (data != 32) & ((data < 9) | (data > 13))
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[lower] * up[:n], out=total[1:])
    return _mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)), np.searchsorted(s, offsets[1:])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text. Fewer than k words are one shingle; none, no shingle."""
    words, ends = word_hashes(data, offsets)
    grams = np.zeros(max(0, len(words) - k + 1), dtype=np.uint64)
    for i in range(k):
        grams += words[i : len(words) - k + 1 + i] * _PLACE[i]
    grams = _mix(grams)
    start = 0
    for end in ends.tolist():
        n = end - start
        if n >= k:
            yield np.unique(grams[start : end - k + 1])
        elif n:
            yield _mix(np.array([(words[start:end] * _PLACE[32 : 32 + n]).sum() + np.uint64(n)], dtype=np.uint64))
        else:
            yield grams[:0]
        start = end


def minwise(s: np.ndarray) -> np.ndarray:
    """MINWISE 32-bit minwise values of a set."""
    low = np.full(MINWISE, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(s), 2048):
        part = (s[at : at + 2048, None] ^ _SALT) * _STEP
        low = np.minimum(low, (part ^ (part >> np.uint64(32))).min(axis=0))
    return (low >> np.uint64(20)).astype(np.uint32)


def paths(values: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Keys of the leaves that rows of minwise values reach: trees * BRANCHES ** depth columns."""
    n = len(values)
    keys = np.broadcast_to(_mix(np.arange(1, trees + 1, dtype=np.uint64)), (n, trees)).copy()
    for level in range(depth):
        grown = []
        for b in range(BRANCHES):
            # The second branch of a node takes another coordinate than the first.
            draw = _mix(keys ^ np.uint64(level + 1))
            first = draw % np.uint64(MINWISE)
            at = first if b == 0 else (first + np.uint64(1) + (draw >> np.uint64(32)) % np.uint64(MINWISE - 1)) % np.uint64(MINWISE)
            value = np.take_along_axis(values, at.astype(np.int64), axis=1).astype(np.uint64)
            grown.append(_mix(keys * np.uint64(0xD1342543DE82EF95) + (at << np.uint64(40)) + value + np.uint64(level)))
        keys = np.concatenate(grown, axis=1)
    return keys


def meet_probability(j: float, trees: int, depth: int) -> float:
    """Lower bound of the chance that a pair of similarity j meets in a leaf."""
    s = 1.0
    for _ in range(depth):
        s = 1 - (1 - j * s) ** BRANCHES
    return 1 - (1 - s) ** trees


def plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(trees, depth) for n representatives."""
    depth = max(1, math.ceil(math.log(max(1.0, n / LEAF_ROWS)) / math.log(1 / CHANCE)))
    trees = 1
    while meet_probability(threshold, trees, depth) < recall:
        trees += 1
    return trees, depth


def _profile(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """doc_id, n, two halves of the set's 128-bit digest, minwise values."""
    for part in slices(batches, limit=1 << 20):
        sizes, digest, values = [], [], []
        for s in shingle_sets(*raw(part.column("text")), k):
            sizes.append(len(s))
            digest.append(xxhash.xxh3_128_digest(s.tobytes()))
            values.append(minwise(s).tobytes() if len(s) else b"")
        halves = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(values, pa.binary())],
            ["doc_id", "n", "ka", "kb", "minwise"],
        )


def _leaf_rows(batches: Iterator[pa.RecordBatch], trees: int, depth: int, sketches: bool) -> Iterator[pa.RecordBatch]:
    """leaf, rep (and sketch): a row for each leaf that a representative reaches."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            data, _ = raw(part.column("minwise"))
            values = np.frombuffer(data.tobytes(), dtype="<u4").reshape(-1, MINWISE)
            keys = paths(values, trees, depth)
            per = keys.shape[1]
            cols = {"leaf": pa.array(keys.reshape(-1).view(np.int64)), "rep": part.column("rep").take(pa.array(np.repeat(np.arange(len(values)), per)))}
            if sketches:
                sketch = np.repeat((values & 255).astype(np.uint8), per, axis=0)
                cols["sketch"] = blobs(sketch.reshape(-1), np.arange(1, len(sketch) + 1) * MINWISE, pa.binary())
            yield pa.RecordBatch.from_pydict(cols)


def estimate_cut(threshold: float) -> int:
    """Equal sketch bytes from which on a pair is a candidate: four standard errors below the threshold."""
    return math.floor(MINWISE * (threshold - 4 * math.sqrt(threshold * (1 - threshold) / MINWISE)))


def connect(sketches: np.ndarray, cut: int) -> list[tuple[int, int, int, int]]:
    """Links (hub, other, equal bytes, links of the hub) of a spanning forest over rows with at least cut
    equal bytes. It is grown from the rows that are most like all others, so that a group of copies of
    one text is a star around it."""
    if len(sketches) > 2:
        common = np.array([np.bincount(c, minlength=256).argmax() for c in sketches.T], dtype=np.uint8)
        left = np.argsort(-(sketches == common).sum(axis=1), kind="stable")
    else:
        left = np.arange(len(sketches))
    links = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            hub = queue.pop(0)
            same = (sketches[left] == sketches[hub]).sum(axis=1)
            near = same >= cut
            if near.any():
                found = left[near].tolist()
                links += [(int(hub), x, n, len(found)) for x, n in zip(found, same[near].tolist())]
                queue += found
                left = left[~near]
    return links


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by keys; only one group is carried between batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.ones(batch.num_rows, dtype=bool)
        new[1:] = False
        for k in keys:
            col = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= col[1:] != col[:-1]
        starts = np.flatnonzero(new)
        last = int(starts[-1])
        if held:
            same = all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
            if not same:
                yield pa.Table.from_batches(held)
                held = []
            elif last > 0:
                stop = int(starts[1])
                yield pa.Table.from_batches([*held, batch.slice(0, stop)])
                held = []
                if stop < last:
                    yield pa.Table.from_batches([batch.slice(stop, last - stop)])
                held = [batch.slice(last)]
                continue
            else:
                held.append(batch)
                continue
        if last > 0:
            yield pa.Table.from_batches([batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _leaf_links(batches: Iterator[pa.RecordBatch], cut: int) -> Iterator[pa.RecordBatch]:
    """u, v, same, hub: candidate links inside leaves, from rows sorted by leaf."""
    for t in _groups(batches, ["leaf", "block"]):
        t = t.combine_chunks()
        key, block, rep = t["leaf"].to_numpy(), t["block"].to_numpy(), t["rep"].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1, [len(key)]])
        sizes = np.diff(starts)
        if not (sizes > 1).any():
            continue
        sketch = t["sketch"].combine_chunks()
        sketch = sketch.chunk(0) if isinstance(sketch, pa.ChunkedArray) else sketch
        rows = raw(sketch)[0].reshape(-1, MINWISE)
        links = []
        for i in np.flatnonzero(sizes > 1).tolist():
            a, b = int(starts[i]), int(starts[i + 1])
            links += [(rep[a + x], rep[a + y], same, hub) for x, y, same, hub in connect(rows[a:b], cut)]
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["u", "v", "same", "hub"])


def _hub_links(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """u, v: the exact links between a hub and the texts dealt to it, from rows sorted by hub, block and
    role, the hub itself first."""
    at, own = None, np.zeros(0, dtype=np.uint64)
    for batch in batches:
        for part in slices([batch], limit=1 << 20):
            found = []
            for hub, block, rep, s in zip(part.column("hub").to_pylist(), part.column("block").to_pylist(), part.column("rep").to_pylist(), shingle_sets(*raw(part.column("text")), k)):
                if at != (hub, block):
                    at, own = (hub, block), s
                    continue
                both = len(np.intersect1d(own, s, assume_unique=True)) if 100 * min(len(own), len(s)) >= percent * max(len(own), len(s)) else 0
                if both and 100 * both >= percent * (len(own) + len(s) - both):
                    found.append((hub, rep))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["u", "v"])


def _block_links(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """u, v: parts (settled) that exactly verified links connect, from rows sorted by class and block."""
    cut = estimate_cut(percent / 100)
    for t in _groups(batches, ["class", "block"]):
        t = t.combine_chunks()
        key, block, settled = t["class"].to_numpy(), t["block"].to_numpy(), t["settled"].to_numpy()
        starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1, [len(key)]])
        text = t["text"].combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if b - a < 2:
                continue
            sets = []
            for at in range(a, b, 64):
                sets += shingle_sets(*raw(text.slice(at, min(64, b - at))), k)
            links = spanning_links(sets, percent, cut, settled[a:b])
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([settled[a + i] for i, _ in links], pa.int64()), pa.array([settled[a + j] for _, j in links], pa.int64())], ["u", "v"])


def spanning_links(sets: list[np.ndarray], percent: int, cut: int, settled: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs with 100 * intersection >= percent * union; sets that
    have one value of settled are connected from the start."""
    m = len(sets)
    parent = list(range(m))
    if settled is not None:
        first: dict[int, int] = {}
        parent = [first.setdefault(x, i) for i, x in enumerate(settled.tolist())]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets])
    sketch = np.stack([(minwise(s) & np.uint32(255)).astype(np.uint8) if len(s) else np.zeros(MINWISE, np.uint8) for s in sets]) if m > 8 else None
    links = []
    for i in range(1, m):
        if not sizes[i]:
            continue
        fits = (100 * np.minimum(sizes[:i], sizes[i]) >= percent * np.maximum(sizes[:i], sizes[i])) & (sizes[:i] > 0)
        others = np.flatnonzero(fits)
        if sketch is not None and len(others):
            same = (sketch[others] == sketch[i]).sum(axis=1)
            order = np.argsort(-same, kind="stable")
            others = others[order][same[order] >= cut]
        for j in others.tolist():
            r = root(j)
            if r == root(i):
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                parent[max(r, root(i))] = min(r, root(i))
                links.append((j, i))
    return links


def _large(rows: DataFrame, key: str, limit: int) -> DataFrame | None:
    """The keys of more than limit rows with their number of blocks (at most rows / limit of them), if any."""
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("of_key")).filter(F.col("of_key") > limit)
    large = materialize(counted.select(F.col(key).alias("large_key"), F.ceil(F.col("of_key") * 2 / limit).alias("parts")), "large-groups")
    return None if large.isEmpty() else large


def _deal(rows: DataFrame, key: str, large: DataFrame | None) -> DataFrame:
    """rows with a block column: 0, but rows of a large key are dealt out as all pairs of its blocks,
    so that any two rows of a key share a block of bounded size."""
    if large is None:
        return rows.withColumn("block", F.lit(0).cast("long"))
    parts = F.col("parts")
    own = F.pmod(F.xxhash64("rep"), parts)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda o: F.least(own, o) * parts + F.greatest(own, o))
    dealt = F.when(parts.isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.array_distinct(pairs))
    joined = rows.join(large, F.col(key) == F.col("large_key"), "left")
    return joined.withColumn("block", F.explode(dealt)).drop("parts", "large_key")


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (unique rep, and others) with text. A filter of the wanted ids goes in front of the merge
    join, so few texts are shuffled besides those wanted."""
    words = filter_words(wanted.select(F.xxhash64("rep").alias("h")))
    likely = may_be_among(rows, F.xxhash64("unit"), words)
    return likely.join(wanted.hint("merge"), likely["unit"] == wanted["rep"]).drop("unit")


def _along_hubs(rows: DataFrame, candidates: DataFrame, k: int, percent: int) -> DataFrame:
    """u, v: exact links along one candidate link a text: to the hub that most texts of a leaf have."""
    likely = (F.col("same") >= MINWISE * percent // 100).cast("int")
    chosen = candidates.groupBy(F.col("v").alias("rep")).agg(F.max(F.struct(likely.alias("likely"), "hub", (-F.col("u")).alias("other"))).alias("best"))
    chosen = materialize(chosen.select("rep", (-F.col("best")["other"]).alias("hub")), "near-forest")
    # A hub's own text goes to each block of the texts that are compared with it.
    hubs = chosen.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    hubs = materialize(hubs.select("hub", "n", F.ceil(F.col("n") / CLASS_BLOCK).alias("parts"), F.col("hub").alias("rep")), "near-hubs")
    own = _texts(rows, hubs).select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("block"), "rep", F.lit(0).alias("role"), "text")
    counted = join_counted(chosen, hubs.select("hub", "n", "parts"), ["hub"], "n", chosen.count())
    others = _texts(rows, counted.select("rep", "hub", "parts")).select("hub", F.pmod(F.xxhash64("rep"), F.col("parts")).alias("block"), "rep", F.lit(1).alias("role"), "text")
    dealt = own.unionByName(others).repartition(partitions(rows.sparkSession), "hub", "block").sortWithinPartitions("hub", "block", "role", "rep")
    links = materialize(map_arrow(dealt.select("hub", "block", "rep", "text"), lambda it: _hub_links(it, k, percent), "u long, v long"), "near-hub-links")
    forget(chosen, hubs)
    return links


def _across(rows: DataFrame, candidates: DataFrame, parts: DataFrame, k: int, percent: int) -> DataFrame | None:
    """u, v: the parts (components of the links so far) that further exact links connect; None if no
    candidate link leads from one part to another.

    Parts that candidate links join are a class. The texts of the largest part of a class are dealt into
    blocks, and the others too; every pair of blocks meets but two of the largest part, which is
    connected already.
    """
    ends = candidates.select("u", "v")
    for end in ("u", "v"):
        to = parts.select(F.col("u").alias("_rep"), F.col("v").alias("_part"))
        ends = ends.join(to.hint("merge"), ends[end] == to["_rep"], "left").withColumn(end, F.coalesce("_part", end)).select("u", "v")
    ends = materialize(ends.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "near-open")
    if ends.isEmpty():
        return None
    classes = components(ends)
    classes = classes.select(F.col("u").alias("settled"), F.col("v").alias("class")).unionByName(classes.select(F.col("v").alias("settled"), F.col("v").alias("class")).distinct())
    linked = parts.select(F.col("u").alias("rep"), F.col("v").alias("settled")).join(classes.hint("merge"), "settled").select("rep", "settled", "class")
    of = materialize(linked.unionByName(classes.select(F.col("settled").alias("rep"), "settled", "class")), "near-parts")
    sizes = of.groupBy("class", "settled").agg(F.count(F.lit(1)).alias("n"))
    per = sizes.groupBy("class").agg(F.max(F.struct("n", "settled")).alias("top"), F.sum("n").alias("n"))
    per = per.select("class", "n", F.col("top")["settled"].alias("main"), F.ceil(F.col("top")["n"] / CLASS_BLOCK).alias("a"), F.ceil((F.col("n") - F.col("top")["n"]) / CLASS_BLOCK).alias("b"))
    a, b, zero = F.col("a"), F.col("b"), F.lit(0).cast("long")
    h = F.xxhash64("rep")
    main = F.col("settled") == F.col("main")
    own = F.when(main, F.pmod(h, a)).otherwise(a + F.pmod(h, b))
    meets = F.when(main, F.sequence(a, a + b - 1)).otherwise(F.sequence(zero, a + b - 1))
    per = materialize(per, "near-classes")
    counted = join_counted(of, per, ["class"], "n", of.count())
    dealt = counted.select("rep", "class", "settled", F.transform(meets, lambda o: F.least(own, o) * (a + b) + F.greatest(own, o)).alias("blocks"))
    dealt = materialize(dealt, "near-blocks")
    texts = _texts(rows, dealt).select("class", "settled", F.explode("blocks").alias("block"), "text")
    texts = texts.repartition(partitions(rows.sparkSession), "class", "block").sortWithinPartitions("class", "block", "settled")
    links = materialize(map_arrow(texts, lambda it: _block_links(it, k, percent), "u long, v long"), "near-block-links")
    forget(ends, of, per, dealt)
    return links


def _linked(docs: DataFrame, k: int, percent: int, recall: float) -> tuple[DataFrame, str, DataFrame]:
    """(docs with the column that tells rows apart, its name, unit, n and component of every row)."""
    given, name = units(docs, nulls_last=True)
    rows = given.select(F.col(name).alias("unit"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    profile = map_arrow(rows.select(F.col("unit").alias("doc_id"), "text"), lambda it: _profile(it, k), "doc_id long, n long, ka long, kb long, minwise binary")
    profile = materialize(profile.withColumnRenamed("doc_id", "unit"), "near-profile")
    # Equal sets become one class before anything is compared.
    real = profile.filter("n > 0")
    reps = materialize(real.groupBy("n", "ka", "kb").agg(F.min("unit").alias("rep"), F.count(F.lit(1)).alias("copies")), "near-reps")
    n_reps, n_real = reps.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    trees, depth = plan(n_reps, percent / 100, recall)
    of = real.join(reps.select("rep").hint("merge"), F.col("unit") == F.col("rep"), "left_semi").select(F.col("unit").alias("rep"), "minwise")
    cut = estimate_cut(percent / 100)
    keys = map_arrow(of, lambda it: _leaf_rows(it, trees, depth, False), "leaf long, rep long")
    leaves = map_arrow(of, lambda it: _leaf_rows(it, trees, depth, True), "leaf long, rep long, sketch binary")
    leaves = _deal(leaves, "leaf", _large(keys, "leaf", LEAF_BLOCK))
    met = leaves.repartition(partitions(docs.sparkSession), "leaf", "block").sortWithinPartitions("leaf", "block", "rep")
    found = materialize(map_arrow(met, lambda it: _leaf_links(it, cut), "u long, v long, same long, hub long"), "near-candidates")
    links = _along_hubs(rows, found, k, percent)
    linked = components(links)
    more = _across(rows, found, linked, k, percent)
    if more is not None:
        joined = components(more).select(F.col("u").alias("part"), F.col("v").alias("top"))
        linked = linked.join(joined.hint("merge"), linked["v"] == joined["part"], "left").select("u", F.coalesce("top", "v").alias("v")).unionByName(joined.select(F.col("part").alias("u"), F.col("top").alias("v")))
    named = reps.join(linked.withColumnRenamed("u", "rep").hint("merge"), "rep", "left").select("n", "ka", "kb", "copies", F.coalesce("v", "rep").alias("component"))
    named = materialize(named, "near-named")
    narrow = profile.select("unit", "n", "ka", "kb")
    joined = join_counted(narrow.filter("n > 0"), named, ["n", "ka", "kb"], "copies", n_real).select("unit", "n", "component")
    out = materialize(joined.unionByName(narrow.filter("n = 0").select("unit", "n", F.col("unit").alias("component"))), "near-components")
    forget(profile, reps, found, named, links, *([more] if more is not None else []))
    return given, name, out


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, recall: float = RECALL) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs.

    Words are split at ASCII white space and A-Z lower-cased. Null texts and texts without words have
    no shingles and link to nothing; fewer than k words are one shingle. Every row is a document of its
    own: rows without a doc_id come after all others, and rows of one doc_id (or of none) are ordered by
    hashes of their texts. component_id is the doc_id of the first row of the component, so the smallest
    (null only if no row of it has one); kept says that the row is that first one, so of rows that are equal in all exactly one stays. Texts of any length
    are read whole. Only doc_id and text are read.
    """
    given, name, found = _linked(docs, k, percent, recall)
    if name == "doc_id":
        return found.select(F.col("unit").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("unit") == F.col("component")).alias("kept"))
    ids = given.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).alias("unit"))
    named = found.join(ids.hint("merge"), "unit").join(ids.select(F.col("doc_id").alias("component_id"), F.col("unit").alias("component")).hint("merge"), "component")
    return named.select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("unit") == F.col("component")).alias("kept"))


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80, recall: float = RECALL) -> DataFrame:
    """The rows of docs that ``near_duplicates`` keeps, decided row by row, with their columns."""
    given, name, found = _linked(docs, k, percent, recall)
    gone = found.filter("unit != component").select(F.col("unit").alias("gone_unit"))
    kept = given.join(gone.hint("merge"), given[name] == gone["gone_unit"], "left_anti")
    return kept.select(*docs.columns)


def op9_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)
