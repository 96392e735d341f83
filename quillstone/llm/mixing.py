"""Mixing sources to target weights by balanced (cube) sampling.

Each source has a target number of words. All documents of a source get the same expected number
of copies, p = target / source size: floor(p) copies are certain, the fraction is drawn. The draw is
a cube-method flight: three fractional units at a time move along the null space of the two
balancing constraints (words, documents) until one of them is 0 or 1. Units fly with units of about
their size, from the largest down. The one or two that are left of a size are landed while smaller
ones are still fractional: from there on the constraint on documents is dropped, and the next smaller
units take up the difference in words, each by the same small shift. The landing problem that remains
is one small unit, or a document that holds too much of its source for the others to make up for it.
It is solved by exact choice: the words that are too many or too few are spread over single copies of
at most LAND_UNITS of the smallest documents (a subset-sum table), so that the source comes as near to
its target as these allow. Expectations are exact up to there.

A run covers one block of one source and leaves one fractional unit at most; these meet in fewer
blocks until each source has one run, whose last unit is landed. A run is BLOCK_ROWS units or so in
memory, whatever the size of its source; a hot source is dealt out in blocks.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import map_pandas
from .common import forget, materialize, table, units, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 20240101
#: Rows of a source that one run of the flight covers, and runs that meet in one run of the next level.
BLOCK_ROWS, FAN_IN = 8192, 2048
#: Documents that the landing may give one copy more or less.
LAND_UNITS = 64
#: Source statistics up to so many rows are broadcast; more are joined by key.
BROADCAST_SOURCES = 10_000
EPS = 1e-9


def source_targets(sized: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """source, src (rank by code point, null last), source_size, n_docs, target: one row per source.

    The shares are filled like water: sources sorted by the level at which they reach their cap.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    per = per.withColumn("src", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("src") - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.lit(float(cap)) * F.col("source_size"))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(float(share)) * F.sum("source_size").over(every)
    per = per.withColumn(
        "level",
        (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    # The level at the first source that it leaves below its cap holds for all from there on.
    free = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("src"), F.col("level").alias("level")))
    per = per.withColumn("water", F.min(free).over(every)["level"])
    target = F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight")))
    return per.select("source", "src", "source_size", "n_docs", target.alias("target"))


def _fly(window: list, pick: random.Random) -> list:
    """Move three units [x, size, ...] along the null vector of (1, size); at least one lands."""
    (x1, s1), (x2, s2), (x3, s3) = (u[:2] for u in window)
    u = (s2 - s3, s3 - s1, s1 - s2)
    if not any(u):
        u = (1.0, -1.0, 0.0)
    up = down = float("inf")
    for x, d in zip((x1, x2, x3), u):
        if d > 0:
            up, down = min(up, (1 - x) / d), min(down, x / d)
        elif d < 0:
            up, down = min(up, -x / d), min(down, (x - 1) / d)
    step = up if pick.random() * (up + down) < down else -down
    for unit, d in zip(window, u):
        unit[0] = _snap(unit[0] + step * d)
    return window


def _fly_pair(window: list, pick: random.Random) -> None:
    """Move two units with their words balanced; at least one lands."""
    (x1, s1), (x2, s2) = (u[:2] for u in window)
    u = (s2, -s1) if s1 or s2 else (1.0, -1.0)
    ups = [(1 - x) / d if d > 0 else -x / d for x, d in zip((x1, x2), u) if d]
    downs = [x / d if d > 0 else (x - 1) / d for x, d in zip((x1, x2), u) if d]
    up, down = min(ups), min(downs)
    step = up if pick.random() * (up + down) < down else -down
    for unit, d in zip(window, u):
        unit[0] = _snap(unit[0] + step * d)


def _snap(x: float) -> float:
    return 0.0 if x < EPS else 1.0 if x > 1 - EPS else x


def _fractional(units: list) -> list:
    return [u for u in units if 0.0 < u[0] < 1.0]


def _hand_down(unit: list, rest: list, pick: random.Random) -> bool:
    """Land a unit and shift the first units of rest (smaller ones) so that the words stay balanced and
    all expectations are kept; as few of them as can take it. False, and nothing done, if they cannot."""
    x, size = unit[:2]
    total, low, high, some = 0.0, 1.0, 0.0, []
    for other in rest:
        if not (0.0 < other[0] < 1.0 and other[1]):
            continue
        some.append(other)
        total, low, high = total + other[1], min(low, other[0]), max(high, other[0])
        off, on = (1 - x) * size / total, x * size / total
        if off <= low and high + on <= 1.0:
            break
    else:
        return False
    lands = pick.random() < x
    unit[0] = 1.0 if lands else 0.0
    for other in some:
        other[0] = _snap(other[0] - off if lands else other[0] + on)
    return True


def settle(units: list, pick: random.Random) -> None:
    """Settle the units [x, size, ...] of one run, given from large to small: x becomes 0 or 1, but for
    one unit at most."""
    window: list = []
    at = 0
    while at < len(units):
        end = at
        while end < len(units) and 2 * units[end][1] >= units[at][1]:
            end += 1
        for unit in units[at:end]:
            if 0.0 < unit[0] < 1.0:
                window.append(unit)
            while len(window) == 3:
                window = _fractional(_fly(window, pick))
        at = end
        rest = units[at:]
        window = [u for u in window if not _hand_down(u, rest, pick)]
    window = _fractional(window)
    if len(window) == 2:
        _fly_pair(window, pick)


def land(units: list, target: float, most: int, pick: random.Random) -> None:
    """Land what settle() has left of a run [x, size, row, whole] and bring its words (x times size) near
    target: documents get a copy more or less, between none and ``most`` (x + whole)."""
    for u in _fractional(units):
        u[0] = float(pick.random() < u[0])
    short = target - sum(x * size for x, size, *_ in units)
    sized = [u for u in units if u[1]]
    for u in sized[:-LAND_UNITS]:  # from large to small: what the smallest may be too few for
        step = 1 if short > 0 else -1
        if u[1] <= abs(short) and 0 <= u[0] + u[3] + step <= most:
            u[0] += step
            short -= step * u[1]
    some = sized[-LAND_UNITS:]
    zero = int(sum(u[1] for u in some))
    reach, reached = 1 << zero, []
    for u in some:
        reached.append(reach)
        one = int(u[1])
        reach |= (reach << one if u[0] + u[3] + 1 <= most else 0) | (reach >> one if u[0] + u[3] >= 1 else 0)
    # The reachable sum nearest to what is short, and a way to it with few changes.
    at = zero + round(short)
    away = next((d for d in range(2 * zero + 1) for y in (at - d, at + d) if y >= 0 and reach >> y & 1), None)
    if away is None:
        return
    at = at - away if at - away >= 0 and reach >> (at - away) & 1 else at + away
    for u, before in zip(reversed(some), reversed(reached)):
        one = int(u[1])
        if before >> at & 1:
            continue
        if u[0] + u[3] + 1 <= most and at >= one and before >> (at - one) & 1:
            u[0], at = u[0] + 1, at - one
        else:
            u[0], at = u[0] - 1, at + one


#: blocks: how many runs the source has at this level.
COLUMNS = ["src", "block", "blocks", "doc", "size", "x", "whole"]


def flight(batches: Iterator[pd.DataFrame], seed: int, level: int, most: int) -> Iterator[pd.DataFrame]:
    """Rows of COLUMNS, sorted by src, block and falling size, settled run by run; the only run of a source is landed too."""
    key, units = None, []

    def run() -> pd.DataFrame:
        pick = random.Random(f"{seed}/{level}/{key[0]}/{key[1]}")
        target = sum(u[0] * u[1] for u in units)
        settle(units, pick)
        if key[2] == 1:
            land(units, target, most, pick)
        return pd.DataFrame([(*key, doc, size, x, whole) for x, size, doc, whole in units], columns=COLUMNS)

    for batch in batches:
        for src, block, blocks, doc, size, x, whole in zip(*(batch[c].tolist() for c in COLUMNS)):
            if (src, block, blocks) != key:
                if units:
                    yield run()
                key, units = (src, block, blocks), []
            units.append([x, size, doc, whole])
    if units:
        yield run()


def mix_plan(docs: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP, seed=SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: one row per row of docs.

    Null or empty texts have size 0: they are drawn as documents and take no words. A null source
    is a source of its own and comes last. A source without words has target 0. Rows that repeat a
    doc_id are separate units. Ties of size are broken by hashed doc_id, so reruns agree. Only
    doc_id, text and source are read. A text of any length is one unit: a document that holds most of
    its source is landed first, and the others make up for it as far as they reach.
    """
    spark = docs.sparkSession
    sized = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")),
        "mix-sizes",
    )
    stats = materialize(source_targets(sized, weights, share, cap), "mix-targets")
    n_sources, largest = stats.agg(F.count(F.lit(1)), F.coalesce(F.max("n_docs"), F.lit(0))).first()
    p = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    whole = F.floor(p + EPS)
    rated = stats.select(
        F.col("source").alias("of"), "src", "source_size", "target", whole.alias("whole"),
        F.when(p - whole < EPS, 0.0).otherwise(p - whole).alias("fraction"),
        F.ceil(F.col("n_docs") / BLOCK_ROWS).alias("blocks"),
    )
    small = F.broadcast(rated) if n_sources <= BROADCAST_SOURCES else rated
    h = F.xxhash64(F.lit(seed), "doc_id")
    units = sized.join(small, F.col("source").eqNullSafe(F.col("of"))).select(
        "src", F.pmod(h, F.col("blocks")).alias("block"), "blocks", "doc_id", F.col("size"), F.col("fraction").alias("x"), "whole", h.alias("h")
    )
    schema = "src int, block long, blocks long, doc long, size double, x double, whole long"
    level, blocks = 0, max(1, -(-largest // BLOCK_ROWS))
    todo = units.select("src", "block", "blocks", F.col("doc_id").alias("doc"), F.col("size").cast("double").alias("size"), "x", "whole", "h")
    done: list[DataFrame] = []
    while True:
        dealt = todo.repartition("src", "block").sortWithinPartitions("src", "block", F.desc("size"), "h", "doc")
        flown = map_pandas(dealt.select(*COLUMNS), lambda it, n=level: flight(it, seed, n, int(cap)), schema)
        flown = materialize(flown, f"mix-flight-{level}")
        if blocks == 1:
            done.append(flown)
            break
        settled = (F.col("blocks") == 1) | F.col("x").isin(0.0, 1.0)
        done.append(flown.filter(settled))
        todo = flown.filter(~settled).withColumn("block", F.floor(F.col("block") / FAN_IN)).withColumn("blocks", F.ceil(F.col("blocks") / FAN_IN)).withColumn("h", F.xxhash64(F.lit(seed), "doc"))
        level, blocks = level + 1, -(-blocks // FAN_IN)
    drawn = done[0]
    for more in done[1:]:
        drawn = drawn.unionByName(more)
    forget(sized)
    rated = stats.select("src", "source_size", "target")
    small = F.broadcast(rated) if n_sources <= BROADCAST_SOURCES else rated
    copies = (F.col("whole") + F.col("x")).cast("long")
    return drawn.join(small, "src").select(
        F.col("doc").alias("doc_id"), F.col("size").cast("long").alias("size"), "source_size", "target",
        (F.col("size").cast("long") * copies).alias("taken"), copies.alias("copies"),
    )


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP, seed=SEED) -> DataFrame:
    """The rows of docs as often as the plan takes them. Each row is drawn by itself, also where rows
    share a doc_id or have none."""
    rows, name = units(docs)
    plan = mix_plan(rows.select(F.col(name).alias("doc_id"), "text", "source"), weights, share, cap, seed)
    plan = plan.filter("copies > 0").select(F.col("doc_id").alias("plan_unit"), F.col("copies").cast("int").alias("plan_copies"))
    taken = rows.join(plan.hint("merge"), rows[name] == plan["plan_unit"])
    copies = F.array_repeat(F.lit(0), plan["plan_copies"])
    return taken.select(*[rows[c] for c in docs.columns], F.explode(copies).alias("_mix_copy")).drop("_mix_copy")


def op1_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents")).withColumnRenamed("copies", "n_copies")
