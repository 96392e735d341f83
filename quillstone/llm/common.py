"""Tables, the shared scratch folder and small column helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir).

    Only a local session without that setting gets a folder of its own; elsewhere a missing
    setting is an error, since executors would not see each other's files.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = set_dir.get() if set_dir.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = os.path.join(tempfile.gettempdir(), "quillstone-checkpoints")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a table written once to the shared folder: lineage is cut, and a lost
    executor costs no recomputation of what came before. Its folder is in ``forget``'s reach."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables of materialize() that nothing will read any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch)
        conf = df.sparkSession._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def units(docs: DataFrame, nulls_last: bool = False) -> tuple[DataFrame, str]:
    """(docs, the column that tells its rows apart and orders them): a long, unique, never null.

    That is doc_id where it is so. Otherwise each row gets a number (a new column), in the order of
    doc_id, nulls first (or last), then of hashes of text; rows equal in both are in no certain order.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    if ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id"
    taken, name = {c.lower() for c in docs.columns}, "_unit"
    while any(c.startswith(name) for c in taken):
        name += "_"
    text = F.col("text").cast("string")
    keys = {f"{name}0": F.col("doc_id").cast("long"), f"{name}1": F.xxhash64(text), f"{name}2": F.xxhash64(F.lit(7), text), f"{name}3": F.monotonically_increasing_id()}
    # The last key only deals equal rows over tasks. Ids given after a total sort rise with it.
    by_id = F.col(f"{name}0").asc_nulls_last() if nulls_last else F.col(f"{name}0").asc_nulls_first()
    ordered = docs.withColumns(keys).orderBy(by_id, *list(keys)[1:]).drop(*keys)
    return materialize(ordered.withColumn(name, F.monotonically_increasing_id()), "units"), name


#: Bounds of what is broadcast: words of 64 bits in a filter of keys, and keys that have most rows.
FILTER_WORDS, HEAVY_KEYS, HEAVY_ROWS = 1 << 19, 10_000, 100


def filter_words(hashes: DataFrame) -> DataFrame:
    """A Bloom filter with one hash function of the column h (long): word, bits. It has at most
    FILTER_WORDS rows of 16 bytes however many keys there are; when it fills up it only lets more pass."""
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 40) & 63 AS int))")
    return hashes.select(F.pmod("h", F.lit(FILTER_WORDS).cast("long")).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def may_be_among(rows: DataFrame, h: Column, words: DataFrame) -> DataFrame:
    """The rows whose hash h the filter words does not rule out, without a shuffle: all of those whose
    key went into the filter, and few others. No column of rows may be called _word, _bits or _h."""
    held = F.broadcast(words.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    tested = rows.withColumn("_h", h)
    inside = F.expr("(shiftrightunsigned(_bits, cast(shiftrightunsigned(_h, 40) & 63 AS int)) & 1) = 1")
    return tested.join(held, (F.pmod("_h", F.lit(FILTER_WORDS).cast("long")) == F.col("_word")) & inside).select(*[rows[c] for c in rows.columns])


def ruled_out(rows: DataFrame, h: Column, words: DataFrame) -> DataFrame:
    """The rows that ``may_be_among`` leaves out."""
    held = F.broadcast(words.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    tested = rows.withColumn("_h", h)
    inside = F.expr("(shiftrightunsigned(_bits, cast(shiftrightunsigned(_h, 40) & 63 AS int)) & 1) = 1")
    return tested.join(held, (F.pmod("_h", F.lit(FILTER_WORDS).cast("long")) == F.col("_word")) & inside, "left_anti").select(*[rows[c] for c in rows.columns])


def join_counted(rows: DataFrame, per: DataFrame, on: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined (inner or left) with per, which has one row a key and in the column count how many of rows have it.

    The counts add up to total at most. So no more than HEAVY_KEYS keys have more than
    total / HEAVY_KEYS rows: these are broadcast, and no task of the join of the others holds many rows of a key.
    """
    limit = max(HEAVY_ROWS, total // HEAVY_KEYS)
    heavy, light = per.filter(F.col(count) > limit), per.filter(F.col(count) <= limit)
    spread = rows.join(F.broadcast(heavy), on)
    others = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return spread.unionByName(others.join(light.hint("merge"), on, how))


def word_count(text: Column) -> Column:
    """Number of words as long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
