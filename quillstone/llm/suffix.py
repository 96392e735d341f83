"""Removal of repeated byte strings by column-wise construction over many documents.

Every string of LENGTH bytes that also starts earlier (in an earlier document, or earlier in its own)
is removed. Whole documents cannot be inserted column by column at scale, since the number of rounds
is the longest text; they are cut into short aligned pieces first, in a way that loses no match:

1.  In each window of LENGTH bytes the smallest hashed gram is its anchor. Equal windows have equal
    anchors at the same place, so a window need only be compared with windows of the same gram.
    Consecutive windows with one anchor make a piece; a text has a piece about every 40 bytes.
2.  Pieces meet by gram and content (a shuffle of two hashes and a place a piece, no text; repeats inside
    a slice are known before it and dealt anywhere). Of equal pieces all but the earliest are repeated as
    a whole. Grams are counted, and the different pieces of a gram that has several go on.
3.  Their bytes are fetched and aligned at the anchor, and the positional form of the collection
    Burrows-Wheeler transform is built over them: each round inserts one symbol of every piece, by a
    stable distribution in the order of the round before, and updates where the common part with the
    neighbour begins. Neighbours whose common part reaches back LENGTH columns hold the same window;
    all but the earliest of them are repeated. Shuffle runs are the sequential external files.
4.  A gram with more different pieces than one task should hold is not transformed: its windows are
    grouped by their bytes, by aggregation and a counted join, which no gram or window makes uneven.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .common import filter_words, forget, join_counted, materialize, may_be_among, partitions, table, units
from .texts import blobs, raw, slices

LENGTH = 100
GRAM = 20
REACH = LENGTH - GRAM  # a window's anchor starts at most so far behind its first byte
WIDTH = REACH + LENGTH  # columns of aligned pieces: from REACH before the anchor on
#: Window starts handled at once in a long text, and pieces in one transform.
SEGMENT, PIECES = 4 << 20, 40_000
#: A gram goes by windows if it has more different pieces than a quarter of a task's share of all, within these bounds.
LARGE_LEAST, LARGE_MOST = 2000, 200_000

_RNG = np.random.default_rng(411)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xB5AD4ECEDA1CE2A9


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place on, by doubling."""
    h = _BYTE[data]
    held, n = {1: h}, 1
    while 2 * n <= GRAM:
        h = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
        held[n] = h
    rest = GRAM - n
    while rest:
        m = 1 << (rest.bit_length() - 1)
        tail = held[m][n:]
        h = h[: len(tail)] * np.uint64(pow(_BASE, m, 1 << 64)) + tail
        n, rest = n + m, rest - m
    return _mix(h)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        v = np.minimum(v[:-n], v[n:])
        n *= 2
    return np.minimum(v[: len(v) - (width - n)], v[width - n :]) if width > n else v


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram hash, piece hash, text number, anchor, first and last window start) of every piece;
    places count from the start of the text."""
    found = []
    for base in range(0, max(1, len(data) - LENGTH + 1), SEGMENT):
        part = data[base : base + SEGMENT + LENGTH - 1]
        if len(part) < LENGTH:
            break
        n = len(part) - LENGTH + 1
        inside = np.zeros(len(part) + 1, dtype=np.int32)
        starts, ends = np.clip(offsets[:-1] - base, 0, len(part)), np.clip(offsets[1:] - base, 0, len(part))
        long = ends - starts >= LENGTH
        np.add.at(inside, starts[long], 1)
        np.add.at(inside, ends[long] - LENGTH + 1, -1)
        valid = np.cumsum(inside)[:n] > 0
        h = gram_hashes(part)
        order = (h >> np.uint64(28) << np.uint64(28)) | np.arange(len(h), dtype=np.uint64)
        anchor = (sliding_min(order, REACH + 1) & np.uint64((1 << 28) - 1)).astype(np.int64)[:n]
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        last = valid.copy()
        last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
        lo, hi = np.flatnonzero(new), np.flatnonzero(last)
        at = anchor[lo]
        whole = part.tobytes()
        fh = np.array([xxhash.xxh3_64_intdigest(whole[a : b + LENGTH], c) for a, b, c in zip(lo.tolist(), hi.tolist(), (at - lo).tolist())], dtype=np.uint64)
        text = np.searchsorted(offsets, lo + base, side="right") - 1
        shift = base - offsets[text]
        found.append((h[at], fh, text, at + shift, lo + shift, hi + shift))
    if not found:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found))


def pack(anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Place of a piece as one long: anchor, distance of the first and of the last window to it."""
    return anchor << 14 | (anchor - lo) << 7 | (anchor - hi)


def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    anchor = place >> 14
    return anchor, anchor - (place >> 7 & 127), anchor - (place & 127)


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, piece, doc, place, salt. Equal pieces of a slice but the earliest are known repeats: they
    need not meet any other, and have a salt instead of gram and piece; that of the others is 0."""
    for part in slices(batches, limit=2 << 20):
        gram, piece, text, anchor, lo, hi = pieces(*raw(part.column("text")))
        doc = part.column("doc_id").to_numpy()[text]
        place = pack(anchor, lo, hi)
        order = np.lexsort((place, doc, piece, gram))
        gram, piece, doc, place = gram[order], piece[order], doc[order], place[order]
        known = np.zeros(len(gram), dtype=bool)
        known[1:] = (gram[1:] == gram[:-1]) & (piece[1:] == piece[:-1])
        salt = np.where(known, 1 + (np.arange(len(gram)) & 4095), 0).astype(np.int32)
        gram[known] = piece[known] = 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram.view(np.int64)), pa.array(piece.view(np.int64)), pa.array(doc), pa.array(place), pa.array(salt)], ["gram", "piece", "doc", "place", "salt"]
        )


def _sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, doc, place, repeated, from rows sorted by salt, gram, piece, doc, place: rows but the first
    of their piece are repeated, and so are those with a salt."""
    at = (None, None)  # gram and piece of the row before
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, piece, salt = (batch.column(c).to_numpy() for c in ("gram", "piece", "salt"))
        repeated = np.zeros(len(gram), dtype=bool)
        repeated[1:] = (gram[1:] == gram[:-1]) & (piece[1:] == piece[:-1])
        repeated[0] = (gram[0], piece[0]) == at
        at = (gram[-1], piece[-1])
        yield pa.RecordBatch.from_arrays([batch.column("gram"), batch.column("doc"), batch.column("place"), pa.array(repeated | (salt > 0))], ["gram", "doc", "place", "repeated"])


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """gram, doc, place, bytes: the bytes of the wanted pieces of each text."""
    for part in slices(batches, limit=2 << 20):
        data, offsets = raw(part.column("text"))
        wanted = part.column("wanted")
        per = np.diff(wanted.offsets.to_numpy())
        flat = wanted.flatten()
        gram, place = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        row = np.repeat(np.arange(part.num_rows), per)
        _, lo, hi = unpack(place)
        starts, counts = offsets[row] + lo, hi - lo + LENGTH
        for i in range(0, len(gram), 8192):
            s, c = starts[i : i + 8192], counts[i : i + 8192]
            ends = np.cumsum(c)
            picked = data[np.repeat(s - (ends - c), c) + np.arange(int(ends[-1]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[i : i + 8192]), pa.array(part.column("doc_id").to_numpy()[row[i : i + 8192]]), pa.array(place[i : i + 8192]), blobs(picked, ends, pa.binary())],
                ["gram", "doc", "place", "bytes"],
            )


def repeated_windows(symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which windows of aligned pieces are repeated: bool, pieces x window starts.

    symbols: pieces x WIDTH, 256 where a piece has no byte; lo, hi: first and last window start
    (columns); rank: unique, smaller is earlier. Column by column, order is the positional transform:
    pieces sorted by their symbols read backwards from the column; since[i] is the column from which
    on piece i agrees with its neighbour before it.
    """
    n = len(symbols)
    flags = np.zeros((n, WIDTH - LENGTH + 1), dtype=bool)
    order = np.arange(n)
    since = np.zeros(n, dtype=np.int16)
    columns = np.ascontiguousarray(symbols.T)
    levels = max(1, int(n).bit_length())
    log = np.zeros(n + 1, dtype=np.int8)
    log[1:] = np.floor(np.log2(np.arange(1, n + 1))).astype(np.int8)
    none = np.int64(1 << 62)
    for e in range(WIDTH):
        s = columns[e][order]
        to = np.argsort(s, kind="stable")
        # The common part with the new neighbour begins at the latest start between the two.
        tops = [since]
        for j in range(1, levels):
            half = 1 << (j - 1)
            before = tops[-1]
            if len(before) <= half:
                break
            tops.append(np.maximum(before[:-half], before[half:]))
        fresh = np.full(n, e + 1, dtype=np.int16)
        same = s[to[1:]] == s[to[:-1]]
        left, right = to[:-1][same] + 1, to[1:][same] + 1
        j = log[right - left]
        best = np.empty(len(left), dtype=np.int16)
        for level in np.unique(j).tolist():
            k = j == level
            best[k] = np.maximum(tops[level][left[k]], tops[level][right[k] - (1 << level)])
        fresh[1:][same] = best
        order, since = order[to], fresh
        w = e - LENGTH + 1
        if w >= 0:
            valid = (lo[order] <= w) & (w <= hi[order])
            if valid.any():
                edge = since > w
                edge[0] = True
                r = np.where(valid, rank[order], none)
                least = np.minimum.reduceat(r, np.flatnonzero(edge))[np.cumsum(edge) - 1]
                flags[order, w] = valid & (r != least)
    return flags


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, s, e: repeated ranges of texts, from pieces sorted by gram; the pieces of a gram stay together."""
    held: list[pa.RecordBatch] = []

    def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        col = t["bytes"].combine_chunks()
        col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
        data, offsets = raw(col)
        doc, place = t["doc"].to_numpy(), t["place"].to_numpy()
        anchor, lo, hi = unpack(place)
        begin = lo - anchor + REACH
        symbols = np.full((len(doc), WIDTH), 256, dtype=np.uint16)
        width = np.diff(offsets)
        row = np.repeat(np.arange(len(doc)), width)
        symbols[row, np.arange(len(data)) - np.repeat(offsets[:-1] - begin, width)] = data
        rank = np.empty(len(doc), dtype=np.int64)
        rank[np.lexsort((anchor, doc))] = np.arange(len(doc))
        flags = repeated_windows(symbols, begin, hi - anchor + REACH, rank)
        padded = np.zeros((len(doc), flags.shape[1] + 2), dtype=np.int8)
        padded[:, 1:-1] = flags
        step = np.diff(padded, axis=1)
        who, s = np.nonzero(step == 1)
        _, e = np.nonzero(step == -1)
        base = anchor[who] - REACH
        return pa.RecordBatch.from_arrays([pa.array(doc[who]), pa.array(base + s), pa.array(base + e - 1 + LENGTH)], ["doc", "s", "e"])

    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("gram").to_numpy()
        cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if held and held[-1].column("gram")[-1].as_py() != key[0]:
            if n >= PIECES:
                yield flush(held)
                held, n = [], 0
        if n + last >= PIECES and last:
            yield flush([*held, batch.slice(0, last)])
            held, n = [batch.slice(last)], batch.num_rows - last
        else:
            held.append(batch)
            n += batch.num_rows
    if held:
        yield flush(held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_bytes, removed, kept: ranges merged, and the bytes outside them."""
    kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
    for part in slices(batches, limit=4 << 20):
        data, offsets = raw(part.column("text"))
        ranges = part.column("ranges")
        per = np.diff(ranges.offsets.to_numpy()) if len(ranges) else []
        removed, kept = [], []
        at = 0
        flat = ranges.flatten()
        s_all, e_all = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        for i, n in enumerate(per):
            whole = data[offsets[i] : offsets[i + 1]]
            if not n:
                removed.append([])
                kept.append(whole.tobytes())
                continue
            s, e = s_all[at : at + n], e_all[at : at + n]
            at += n
            order = np.argsort(s, kind="stable")
            s, e = s[order], np.maximum.accumulate(e[order])
            new = np.ones(n, dtype=bool)
            new[1:] = s[1:] > e[:-1]
            begin = s[new]
            end = e[np.append(np.flatnonzero(new)[1:] - 1, n - 1)]
            removed.append([{"s": a, "e": b} for a, b in zip(begin.tolist(), end.tolist())])
            stay = np.ones(len(whole) + 1, dtype=np.int32)
            step = np.zeros(len(whole) + 1, dtype=np.int32)
            step[begin] += 1
            step[end] -= 1
            stay = np.cumsum(step)[:-1] == 0
            kept.append(whole[stay].tobytes())
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"]
        )


def _by_windows(cut: DataFrame) -> DataFrame:
    """doc, s, e: the repeated windows of pieces, each with all windows of equal bytes."""
    begin = F.shiftright("place", 14) - F.shiftright("place", 7).bitwiseAND(F.lit(127))
    starts = F.explode(F.sequence(F.lit(0), F.length("bytes") - LENGTH)).alias("w")
    windows = cut.select("doc", begin.alias("begin"), "bytes", starts).select("doc", (F.col("begin") + F.col("w")).alias("s"), F.substring("bytes", F.col("w") + 1, F.lit(LENGTH)).alias("window"))
    seen = windows.groupBy("window").agg(F.min(F.struct("doc", "s")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    seen = materialize(seen, "suffix-windows")
    total = seen.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    again = join_counted(windows, seen, ["window"], "n", total).filter(F.struct("doc", "s") != F.col("first"))
    return materialize(again.select("doc", "s", (F.col("s") + LENGTH).alias("e")), "suffix-window-ranges")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """doc, s, e: byte ranges of docs (doc_id long and unique, text not null) covered by repeated windows."""
    spark = docs.sparkSession
    rows = map_arrow(docs, _piece_rows, "gram long, piece long, doc long, place long, salt int")
    met = rows.repartition(partitions(spark), "gram", "piece", "salt").sortWithinPartitions("salt", "gram", "piece", "doc", "place")
    sorted_out = materialize(map_arrow(met, _sort_out, "gram long, doc long, place long, repeated boolean"), "suffix-pieces")
    whole = sorted_out.filter("repeated").select(
        "doc", (F.shiftright("place", 14) - F.shiftright("place", 7).bitwiseAND(F.lit(127))).alias("s"), (F.shiftright("place", 14) - F.col("place").bitwiseAND(F.lit(127)) + LENGTH).alias("e")
    )
    different = sorted_out.filter("NOT repeated").select("gram", "doc", "place")
    grams = materialize(different.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "suffix-grams")
    total, most = grams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    words = materialize(filter_words(grams.select(F.xxhash64("gram").alias("h"))), "suffix-filter")
    shared = join_counted(may_be_among(different, F.xxhash64("gram"), words), grams, ["gram"], "n", total).select("gram", "doc", "place")
    wanted = shared.groupBy("doc").agg(F.collect_list(F.struct("gram", "place")).alias("wanted"))
    cut = map_arrow(docs.join(wanted.hint("merge"), docs["doc_id"] == wanted["doc"]).select("doc_id", "text", "wanted"), _cut_pieces, "gram long, doc long, place long, bytes binary")
    cut = fetched = materialize(cut, "suffix-cut")
    limit = min(LARGE_MOST, max(LARGE_LEAST, total // (4 * partitions(spark))))
    found = whole
    if most > limit:
        # At most 4 * partitions grams, or total / LARGE_LEAST of them where that is less.
        large = F.broadcast(grams.filter(F.col("n") > limit).select("gram"))
        found = found.unionByName(_by_windows(cut.join(large, "gram", "left_semi")))
        cut = cut.join(large, "gram", "left_anti")
    dealt = cut.repartition(partitions(spark), "gram").sortWithinPartitions("gram")
    found = materialize(found.unionByName(map_arrow(dealt, _compare, "doc long, s long, e long")), "suffix-ranges")
    forget(sorted_out, grams, words, fetched)
    return found


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed array<struct<s, e>>, kept binary: one row per row of docs.

    Texts are UTF-8 bytes; null is empty; texts shorter than LENGTH keep everything. Every row is a
    document of its own: rows without a doc_id come before all others, and rows of one doc_id (or of
    none) are ordered by hashes of their texts. Only doc_id and text are read.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows, unit = units(ids)
    rows = rows.select(F.col("doc_id").alias("id"), F.col(unit).alias("doc_id"), "text")
    found = repeated_ranges(rows.select("doc_id", "text"))
    per = found.groupBy("doc").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    joined = rows.join(per.hint("merge"), rows["doc_id"] == per["doc"], "left")
    joined = joined.select(F.col("id").alias("doc_id"), "text", F.coalesce("ranges", F.array().cast("array<struct<s:long,e:long>>")).alias("ranges"))
    return map_arrow(joined, _merge, "doc_id long, n_bytes long, removed array<struct<s:long,e:long>>, kept binary")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
