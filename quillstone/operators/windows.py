"""Ordered scans as window expressions. Every partition is one document, key or stream, never a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], at: str, tie: str) -> DataFrame:
    """One row a key: the newest, undated rows last, of equal times the smallest ``tie``. Rank limits
    are pushed below the shuffle, so a hot key sends one row a task."""
    order = Window.partitionBy(*key).orderBy(F.col(at).desc_nulls_last(), F.col(tie).asc())
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def head(df: DataFrame, key: list[str], sequence: str, well_formed: Column) -> DataFrame:
    """The highest sequence of each key; one malformed entry spoils the whole key."""
    return df.groupBy(*key).agg(F.max(sequence).alias("head"), F.bool_or(~well_formed).alias("poisoned"), F.count(F.lit(1)).alias("entries"))


def chain(df: DataFrame, key: str, sequence: str, digest: str, previous: str) -> DataFrame:
    """Whether each entry names the digest of the one before it and follows it by one."""
    order = Window.partitionBy(key).orderBy(sequence)
    before, number = F.lag(digest).over(order), F.lag(sequence).over(order)
    first = number.isNull()
    sound = F.when(first, F.col(previous).isNull()).otherwise((F.col(previous) == before) & (F.col(sequence) == number + 1))
    return df.withColumn("linked", F.coalesce(sound, F.lit(False)))


def forward_fill(df: DataFrame, key: list[str], order: str, value: Column, name: str) -> DataFrame:
    """The last value that is not null, at or before each row."""
    over = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(over))


def out_of_order(df: DataFrame, key: list[str], order: list[str], rank: str) -> DataFrame:
    """Rows whose rank is below the largest one before them."""
    over = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("highest_before", F.max(rank).over(over)).filter(F.col(rank) < F.col("highest_before"))


def islands(df: DataFrame, key: list[str], order: str, apart: Column, name: str = "island") -> DataFrame:
    """Number of the run that each row belongs to; ``apart`` tells where a new run starts."""
    over = Window.partitionBy(*key).orderBy(order)
    return df.withColumn(name, F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(over.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def sliding(df: DataFrame, key: list[str], order: str, text: str, n: int) -> DataFrame:
    """Each row's text joined with that of the n - 1 rows after it."""
    over = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.currentRow, n - 1)
    return df.withColumn("joined", F.array_join(F.collect_list(text).over(over), " ")).withColumn("n_joined", F.count(text).over(over))
