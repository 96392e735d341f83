"""Joins with checked cardinality, differences of versions, and joins on sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lookup sides of up to so many rows are broadcast; larger ones are joined by a shuffle.
SMALL = 20_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """df with a broadcast hint if it has at most ``rows`` rows (counted up to that), else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def matched(rules: DataFrame, rows: DataFrame, key: str, required: Column) -> DataFrame:
    """Every rule with the number of its rows and what that makes it: mapped, missing, ambiguous or absent."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_matches"))
    joined = rules.join(counts, key, "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))
    state = F.when(F.col("n_matches") == 1, "mapped").when(F.col("n_matches") > 1, "ambiguous").when(required, "missing").otherwise("absent")
    return joined.withColumn("state", state)


def difference(before: DataFrame, after: DataFrame, key: list[str], value: str) -> DataFrame:
    """Full outer comparison by key: added, removed, changed or unchanged."""
    b = before.select(*key, F.col(value).alias("before"), F.lit(True).alias("in_before"))
    a = after.select(*key, F.col(value).alias("after"), F.lit(True).alias("in_after"))
    change = (
        F.when(F.col("in_before").isNull(), "added").when(F.col("in_after").isNull(), "removed").when(F.col("before").eqNullSafe(F.col("after")), "unchanged").otherwise("changed")
    )
    return b.join(a, key, "full_outer").withColumn("change", change).drop("in_before", "in_after")


def set_equality(left: DataFrame, right: DataFrame, members: str) -> DataFrame:
    """Rows of left and right whose member sets are equal; left rows without partner are kept.

    The sorted distinct members are the key, so the join is an ordinary equi-join."""
    of = lambda d: d.withColumn("_set", F.array_join(F.array_sort(F.array_distinct(members)), "\x1f"))
    return of(left).join(of(right).drop(members), "_set", "left").drop("_set")


def poisoned(rows: DataFrame, known: DataFrame, key: str, record: str) -> DataFrame:
    """Records with a row whose key is not known: they are refused whole."""
    return rows.join(known.select(key), key, "left_anti").select(record).distinct()
