"""Writers: append-only versions with an expected predecessor, write-once runs, ledger, content store."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import written


def commit_versions(current: DataFrame, writes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted new version rows, conflicts). writes: id, expected (null: must not exist), body.

    Nothing is changed in place: an accepted write is a row with the next version."""
    newest = current.groupBy("id").agg(F.max("version").alias("newest"))
    joined = writes.join(newest, "id", "left")
    fits = F.col("newest").eqNullSafe(F.col("expected"))
    accepted = joined.filter(fits).select("id", (F.coalesce("newest", F.lit(0)) + 1).alias("version"), "body")
    return accepted, joined.filter(~fits).select("id", "expected", "newest")


def write_once(df: DataFrame, path: str) -> bool:
    """Write a run's folder unless it is there; whether it was written."""
    try:
        df.write.mode("errorifexists").parquet(path)
    except Exception as e:  # only what says that the folder is there
        if "PATH_ALREADY_EXISTS" not in str(e):
            raise
        return False
    return True


def append_new(df: DataFrame, path: str, key: str) -> int:
    """Append rows whose key the table does not hold, each key once; how many."""
    spark = df.sparkSession
    rows = df.dropDuplicates([key])
    if exists(spark, path):
        rows = rows.join(spark.read.schema(df.schema).parquet(path).select(key), key, "left_anti")
    rows = rows.persist()
    n = rows.count()
    if n:
        rows.select(*df.columns).write.mode("append").parquet(path)
    rows.unpersist()
    return n


#: Seconds that a write waits before each further attempt.
LADDER = (2, 5, 15, 30, 60)


def with_retries(write, ladder=LADDER, sleep=time.sleep):
    """The result of ``write()``, tried again after each wait of the ladder; the last failure is raised."""
    for wait in ladder:
        try:
            return write()
        except Exception:  # whatever it was, the next attempt decides
            sleep(wait)
    return write()


def ingest(df: DataFrame, path: str, key: str) -> int:
    """Store content once under its digest; how many rows were new. Digests are compared first, so only the
    bytes of new content are moved."""
    spark = df.sparkSession
    keys = df.select(key).distinct()
    if exists(spark, path):
        keys = keys.join(spark.read.schema(df.schema).parquet(path).select(key), key, "left_anti")
    fresh = written(keys, "ingest-new")
    n = fresh.count()
    if n:
        df.join(fresh, key, "left_semi").dropDuplicates([key]).write.mode("append").parquet(path)
    return n


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def append_days(df: DataFrame, path: str, at: str, batch: int | None = None) -> None:
    """Append under one folder a day, so readers of a day read that day. A batch with a number has a folder of its
    own below each day, which it replaces: a batch that is sent again is not written twice. A day's rows are
    dealt out by the engine, not to one task."""
    dated = df.withColumn("day", F.to_date(at))
    if batch is None:
        dated.write.mode("append").partitionBy("day").parquet(path)
        return
    numbered = dated.withColumn("batch", F.lit(batch))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(path)


def expire_days(spark: SparkSession, path: str, before: str) -> int:
    """Delete day folders before a date; how many."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("day=") and s.getPath().getName()[4:] < before]
    for folder in old:
        fs.delete(folder, True)
    return len(old)


def ledger_rows(runs: DataFrame) -> DataFrame:
    """One flat row a run from its manifest struct."""
    m = F.col("manifest")
    return runs.select(
        "run_id", m["status"].alias("status"), m["environment"].alias("environment"), m["completed_at"].alias("completed_at"), F.to_json(m).alias("manifest_json"), F.sha2(F.to_json(m), 256).alias("manifest_sha256")
    )


def persisted_version(location: Column) -> Column:
    """The version at the end of a response location."""
    return F.regexp_extract(location, "/_history/([^/]+)$", 1)
