"""Connected components of a link table, without any per-node list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, join_counted, materialize

MAX_ROUNDS = 40


def _stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u: then each v is the smallest node of its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def _low(edges: DataFrame) -> DataFrame:
    """u, m, n: each node with the smallest it is linked to, and how many links it has."""
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))


def components(links: DataFrame) -> DataFrame:
    """u, v: every linked node but the smallest of its component, with that smallest one.

    links has long columns u and v; order, repeats and loops do not matter. Large-star and small-star
    contraction: each round hangs neighbours under the smallest node seen, by minimum and join, so a
    node with any number of neighbours is never one group in memory, nor in one task of the joins
    (``join_counted``). Each round is a written table.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    edges = materialize(edges, "links")
    for _ in range(MAX_ROUNDS):
        if _stars(edges):
            return edges
        n = 2 * edges.count()
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = join_counted(both, _low(both), ["u"], "n", n).withColumn("m", F.least("u", "m"))
        large = materialize(least.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct(), "large-star")
        forget(edges)
        low = _low(large)
        hung = join_counted(large, low, ["u"], "n", n).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        forget(large)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
