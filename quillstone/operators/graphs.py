"""Order of resources by what they need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import written

MAX_DEPTH = 500


def depths(nodes: DataFrame, needs: DataFrame) -> DataFrame:
    """id, depth, refused: how far each node stands behind nodes that need nothing. needs: id, needs.

    Rounds peel off the nodes whose needs are all placed; each round is a join and a written table. What
    is left when a round places nothing lies on a cycle or behind one, and is refused, with no depth.
    References to nodes that are not there do not count.
    """
    there = nodes.select(F.col("id").alias("needs"))
    left = written(nodes.join(needs.join(there, "needs", "left_semi").filter("id <> needs OR id IS NULL"), "id", "left").select("id", "needs").distinct(), "graph-left")
    placed = None
    for depth in range(MAX_DEPTH):
        free = left.groupBy("id").agg(F.count("needs").alias("n")).filter("n = 0").select("id", F.lit(depth).alias("depth"))
        free = written(free, "graph-free")
        if free.isEmpty():
            break
        placed = free if placed is None else placed.unionByName(free)
        gone = free.select("id")
        rest = left.join(gone, "id", "left_anti")
        done = gone.select(F.col("id").alias("needs"), F.lit(True).alias("done"))
        # An edge to a placed node is dropped; a node keeps one row without need, or its open ones.
        opened = rest.join(done, "needs", "left").filter("done IS NULL").select("id", "needs")
        bare = rest.select("id").distinct().select("id", F.lit(None).cast(dict(left.dtypes)["needs"]).alias("needs"))
        left = written(opened.filter("needs IS NOT NULL").unionByName(bare), "graph-left")
    out = nodes.join(placed, "id", "left") if placed is not None else nodes.withColumn("depth", F.lit(None).cast("int"))
    return out.select("id", "depth", F.col("depth").isNull().alias("refused"))
