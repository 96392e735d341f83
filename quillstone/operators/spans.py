"""Half-open code-point spans: coverage, gaps, overlap, containment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gaps(spans: DataFrame, page: list[str], start: str = "s", end: str = "e") -> DataFrame:
    """Each span with the code points between the end of all spans before it and its start."""
    over = Window.partitionBy(*page).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    cursor = F.coalesce(F.max(end).over(over), F.lit(0))
    return spans.withColumn("gap", F.greatest(F.col(start) - cursor, F.lit(0)))


def neighbours_overlap(spans: DataFrame, page: list[str], owner: str, start: str = "s", end: str = "e") -> DataFrame:
    """Spans that begin before the span next to them in order has ended and belong to another owner.
    Only neighbours are compared, as the verification rule has it."""
    over = Window.partitionBy(*page).orderBy(start, end, owner)
    both = spans.withColumn("before_owner", F.lag(owner).over(over)).withColumn("before_end", F.lag(end).over(over))
    return both.filter((F.col(start) < F.col("before_end")) & (F.col(owner) != F.col("before_owner")))


def outside(places: DataFrame, others: DataFrame, key: list[str]) -> DataFrame:
    """places (key, pos, s, e) that no place of ``others`` of the same key contains: one sweep by start, in
    which a place is contained if an earlier start reaches at least as far. Nothing is paired."""
    o = others.select(*key, "s", "e", F.lit(None).cast("long").alias("pos"), F.lit(0).alias("kind"))
    p = places.select(*key, "s", "e", F.col("pos").cast("long").alias("pos"), F.lit(1).alias("kind"))
    over = Window.partitionBy(*key).orderBy("s", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = o.unionByName(p).withColumn("reach", F.max(F.when(F.col("kind") == 0, F.col("e"))).over(over))
    return swept.filter((F.col("kind") == 1) & ~F.coalesce(F.col("reach") >= F.col("e"), F.lit(False))).drop("kind", "reach")
