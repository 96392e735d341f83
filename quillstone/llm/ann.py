"""Nearest neighbours by learned partitions.

On a bounded sample the neighbour graph is built and cut into balanced parts; a small classifier learns
the part of a vector. Every row of the table is indexed in its most probable part, queries are routed
to their most probable parts (as many as the sample needs for the target recall), and all rows of these
are ranked by the exact inner product. Parts are packed into bins of a bounded number of rows, large
parts dealt out over several; a query goes once to each bin that holds a part of its.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import map_arrow
from .common import materialize, partitions, table

#: The documented bound of the fit: rows of the sample. Parts (a power of two) grow as half the root of
#: the rows between PARTS and PARTS_MOST, for which the sample holds enough rows each.
SAMPLE, PARTS, PARTS_MOST = 4000, 16, 256
NEIGHBOURS, TARGET = 12, 0.95
#: Rows of a bin (a task's share of the table within these bounds), and queries of a bin, that one task compares.
BLOCK_LEAST, BLOCK_MOST, QUERY_BLOCK = 1024, 8192, 20_000


def usable(v: Column) -> Column:
    """Neither null nor zero nor with null or non-finite components."""
    return F.coalesce(
        v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0),
        F.lit(False),
    )


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k rows with the largest inner product with each row, itself left out."""
    out = np.empty((len(x), min(k, len(x) - 1)), dtype=np.int64)
    for at in range(0, len(x), 512):
        s = x[at : at + 512] @ x.T
        s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
        out[at : at + 512] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def _bisect(x: np.ndarray, edges: tuple[np.ndarray, np.ndarray], rows: np.ndarray, rounds: int = 12) -> np.ndarray:
    """A halving of rows that cuts few edges: split along the main direction, then swap the pairs
    that gain most."""
    own = x[rows] - x[rows].mean(axis=0)
    d = own.std(axis=0) + 1e-12
    for _ in range(15):
        d = own.T @ (own @ d)
        d /= np.linalg.norm(d) + 1e-300
    side = np.zeros(len(rows), dtype=bool)
    side[np.argsort(own @ d, kind="stable")[len(rows) // 2 :]] = True
    place = np.full(len(x), -1)
    place[rows] = np.arange(len(rows))
    u, v = place[edges[0]], place[edges[1]]
    u, v = u[(u >= 0) & (v >= 0)], v[(u >= 0) & (v >= 0)]
    for _ in range(rounds):
        cross = side[u] != side[v]
        gain = np.bincount(u, np.where(cross, 1.0, -1.0), len(rows)) + np.bincount(v, np.where(cross, 1.0, -1.0), len(rows))
        a = np.flatnonzero(side)[np.argsort(-gain[side], kind="stable")]
        b = np.flatnonzero(~side)[np.argsort(-gain[~side], kind="stable")]
        n = min(len(a), len(b))
        good = int((gain[a[:n]] + gain[b[:n]] > 0).sum()) // 2
        if not good:
            break
        side[a[:good]], side[b[:good]] = False, True
    return side


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of every row; parts is a power of two, and part sizes differ by a few rows at most."""
    edges = np.repeat(np.arange(len(x)), graph.shape[1]), graph.reshape(-1)
    of = np.zeros(len(x), dtype=np.int64)
    n = 1
    while n < parts:
        for p in range(n):
            rows = np.flatnonzero(of == p)
            if len(rows) > 1:
                of[rows[_bisect(x, edges, rows)]] = p + n
        n *= 2
    return of


class Router:
    """Softmax regression on directions: part probabilities of vectors."""

    def __init__(self, w: np.ndarray, b: np.ndarray, probes: int = 1):
        self.w, self.b, self.probes = w, b, probes

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x / np.linalg.norm(x, axis=1, keepdims=True)) @ self.w + self.b


def train_router(x: np.ndarray, of: np.ndarray, parts: int, rounds: int = 250, rate: float = 0.05) -> Router:
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    truth = np.eye(parts)[of]
    w, b = np.zeros((x.shape[1], parts)), np.zeros(parts)
    m = [np.zeros_like(w), np.zeros_like(b)]
    s = [np.zeros_like(w), np.zeros_like(b)]
    for t in range(1, rounds + 1):
        z = u @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = (p - truth) / len(u)
        for i, (value, grad) in enumerate(((w, u.T @ g + 1e-5 * w), (b, g.sum(axis=0)))):
            m[i] = 0.9 * m[i] + 0.1 * grad
            s[i] = 0.999 * s[i] + 0.001 * grad**2
            value -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.999**t)) + 1e-9)
    return Router(w, b)


def parts_for(rows: int) -> int:
    return min(PARTS_MOST, max(PARTS, 1 << round(math.log2(max(1.0, math.sqrt(rows) / 2)))))


def fit_router(x: np.ndarray, parts: int, k: int = 20, target: float = TARGET) -> Router:
    """A router whose probes reach the target recall on queries that it was not trained on. The sample
    is sparser than the table, so its neighbours are farther apart and the choice errs to more probes."""
    while len(x) < 12 * parts and parts > PARTS:
        parts //= 2
    if len(x) < 4 * parts:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), 1)
    held = np.arange(len(x)) % 8 == 0
    train = x[~held]
    router = train_router(train, balanced_parts(train, neighbour_graph(train, min(NEIGHBOURS, len(train) - 1)), parts), parts)
    index = router.logits(x).argmax(axis=1)
    queries = x[held][:500]
    s = queries @ x.T
    s[np.arange(len(queries)), np.flatnonzero(held)[:500]] = -np.inf
    near = np.argpartition(-s, k - 1, axis=1)[:, :k]
    rank = np.argsort(np.argsort(-router.logits(queries), axis=1), axis=1)
    needed = np.take_along_axis(rank, index[near], axis=1)
    recall = [(needed < r).mean() for r in range(1, parts + 1)]
    router.probes = 1 + int(np.argmax(np.array(recall) >= target))
    return router


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _route(batches: Iterator[pa.RecordBatch], router: Router, width: int, probes: int) -> Iterator[pa.RecordBatch]:
    """The columns with parts: the most probable parts of each vector. Vectors of another width are a
    part of their own, numbered -width."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            v = part.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            usual = np.flatnonzero(sizes == width)
            lists: list = [[-int(n)] for n in sizes]
            if len(usual):
                z = router.logits(matrix(v.take(pa.array(usual))))
                for i, top in zip(usual.tolist(), np.argsort(-z, axis=1, kind="stable")[:, :probes].tolist()):
                    lists[i] = top
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))], [*part.schema.names, "parts"])


def best(scores: np.ndarray, q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, id, score) of the k best candidates of each query by scores (-inf: not compared); equal
    scores by smaller id."""
    out = []
    for i in range(len(q)):
        s = scores[i]
        if len(s) > k:
            edge = s[np.argpartition(-s, k - 1)[k - 1]]
            # The matrix product may round equal vectors differently: near ties are scored again alike.
            near = np.flatnonzero(s >= edge - 1e-9 * max(1.0, abs(edge))) if np.isfinite(edge) else np.flatnonzero(np.isfinite(s))
        else:
            near = np.flatnonzero(np.isfinite(s))
        exact = (c[near] * q[i]).sum(axis=1)
        for j in np.lexsort((c_ids[near], -exact))[:k].tolist():
            out.append((int(q_ids[i]), int(c_ids[near[j]]), float(exact[j])))
    return out


def _rank_bin(c: np.ndarray, c_ids: np.ndarray, c_part: np.ndarray, q: np.ndarray, q_ids: np.ndarray, q_parts: list, k: int) -> Iterator[pa.RecordBatch]:
    """query_id, vec_id, score: the k best of a bin for each query, among the rows of the query's parts."""
    order = np.argsort(c_part, kind="stable")
    c, c_ids, c_part = c[order], c_ids[order], c_part[order]
    edges = np.append(np.flatnonzero(np.append(True, c_part[1:] != c_part[:-1])), len(c_part))
    for at in range(0, len(q), 256):
        some, ids, parts = q[at : at + 256], q_ids[at : at + 256], q_parts[at : at + 256]
        scores = np.full((len(some), len(c)), -np.inf)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            asks = [i for i, p in enumerate(parts) if c_part[a] in p]
            if asks:
                scores[asks, a:b] = some[asks] @ c[a:b].T
        scores[ids[:, None] == c_ids[None, :]] = -np.inf
        found = best(scores, some, ids, c, c_ids, k)
        if found:
            x, y, z = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(z, pa.float64())], ["query_id", "vec_id", "score"])


def _rank(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """query_id, vec_id, score of each bin, from rows sorted by bin and query block."""
    key, held = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        is_query = t["is_query"].to_numpy()
        rows, asked = t.filter(pa.array(~is_query)), t.filter(pa.array(is_query))
        if rows.num_rows and asked.num_rows:
            part = np.array([p[0] for p in rows["parts"].to_pylist()])
            yield from _rank_bin(matrix(rows["v"].combine_chunks()), rows["vec_id"].to_numpy(), part, matrix(asked["v"].combine_chunks()), asked["vec_id"].to_numpy(), [set(p) for p in asked["parts"].to_pylist()], k)

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in ("bin", "q_block")]
        new = np.ones(batch.num_rows, dtype=bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        starts = np.append(np.flatnonzero(new), batch.num_rows)
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            now = tuple(c[a] for c in cols)
            if now != key:
                if held:
                    yield from flush()
                key, held = now, []
            held.append(batch.slice(a, b - a))
    if held:
        yield from flush()


def _bins(sizes: dict[int, int], loads: dict[int, int], block: int) -> dict[int, tuple[int, int, int]]:
    """(first bin, bins, query blocks) of every part. Parts of more than block rows, and those of a width
    of their own, have bins to themselves; others share one as long as it has room."""
    out, at, shared, room = {}, 0, [], 0

    def close() -> None:
        nonlocal at, shared, room
        blocks = max(1, -(-sum(loads.get(p, 0) for p in shared) // QUERY_BLOCK))
        out.update({p: (at, 1, blocks) for p in shared})
        at, shared, room = at + bool(shared), [], 0

    for p in sorted({*sizes, *loads}):
        n = sizes.get(p, 0)
        if p < 0 or n > block:
            close()
            out[p] = (at, max(1, -(-n // block)), max(1, -(-loads.get(p, 0) // QUERY_BLOCK)))
            at += out[p][1]
            continue
        if room + n > block:
            close()
        shared.append(p)
        room += n
    close()
    return out


def _search(placed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the asked rows among the placed ones of their parts."""
    spark = placed.sparkSession
    # One row a part (or another width), however large the table is.
    sizes = {r["p"]: r["n"] for r in placed.groupBy(F.col("parts")[0].alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    loads = {r["p"]: r["n"] for r in asked.select(F.explode("parts").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    bins = _bins(sizes, loads, min(BLOCK_MOST, max(BLOCK_LEAST, sum(sizes.values()) // partitions(spark))))
    spread = F.create_map(*[x for p, (first, n, blocks) in bins.items() for x in (F.lit(p), F.struct(F.lit(first).alias("first"), F.lit(n).alias("n"), F.lit(blocks).alias("blocks")))])
    h = F.xxhash64("row")
    own = spread[F.col("parts")[0]]
    left = placed.withColumn("bin", (own["first"] + F.pmod(h, own["n"])).cast("int")).withColumn("q_block", F.explode(F.sequence(F.lit(0), own["blocks"] - 1)))
    to = F.array_distinct(F.flatten(F.transform("parts", lambda p: F.transform(F.sequence(spread[p]["first"], spread[p]["first"] + spread[p]["n"] - 1), lambda b: F.struct(b.alias("bin"), spread[p]["blocks"].alias("blocks"))))))
    right = asked.withColumn("to", F.explode(to)).withColumn("bin", F.col("to")["bin"]).withColumn("q_block", F.pmod(h, F.col("to")["blocks"]).cast("int"))
    cols = ["bin", "q_block", "vec_id", "v", "parts"]
    both = left.select(*cols, F.lit(False).alias("is_query")).unionByName(right.select(*cols, F.lit(True).alias("is_query")))
    dealt = both.repartition(partitions(spark), "bin", "q_block").sortWithinPartitions("bin", "q_block")
    found = map_arrow(dealt, lambda it: _rank(it, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, sample: int = SAMPLE, target: float = TARGET, parts: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row, by inner product.

    vectors has vec_id and embedding; ``queries`` says which of its rows are queries. A row that is
    null, zero or not finite takes no part, nor does one without vec_id. Vectors are compared with those
    of their own width: the most common one has learned parts, others are ranked exhaustively. Rows that
    repeat a vec_id are candidates of their own, but never of a query with that id; if it is a query's,
    the best k over all its rows are one list. Fewer candidates than k give fewer rows: a query whose
    parts hold fewer is asked again in all parts. Other columns are not read.
    """
    spark = vectors.sparkSession
    clean = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), queries.alias("is_query")).filter(
        usable(F.col("v")) & F.col("vec_id").isNotNull()
    )
    clean = materialize(clean.withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    widths = clean.groupBy(F.size("v").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(1).collect()
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, rows = widths[0]
    fitted = clean.filter(F.size("v") == width).orderBy(F.xxhash64("vec_id"), "vec_id", "row").select("v").limit(sample).collect()
    router = fit_router(np.array([r[0] for r in fitted], dtype=np.float64), parts or parts_for(rows), k, target)
    kind = "row long, vec_id long, v array<double>, parts array<int>"
    placed = materialize(map_arrow(clean.select("row", "vec_id", "v"), lambda it: _route(it, router, width, 1), kind), "ann-index")
    asked = materialize(map_arrow(clean.filter("is_query").select("row", "vec_id", "v"), lambda it: _route(it, router, width, router.probes), kind), "ann-queries")
    found = materialize(_search(placed, asked, k), "ann-found")
    all_parts = router.w.shape[1]
    if router.probes < all_parts and rows > 1:
        full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(k, rows - 1)).select("query_id")
        usual = asked.filter(F.size("v") == width)
        short = materialize(usual.join(full, usual["vec_id"] == full["query_id"], "left_anti").withColumn("parts", F.array(*[F.lit(i) for i in range(all_parts)])), "ann-short")
        if not short.isEmpty():
            again = _search(placed, short, k)
            kept = found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti")
            found = kept.unionByName(again)
    return found


def op10_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)))
