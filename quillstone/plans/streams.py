"""Streaming queries and sinks over the tables, each run to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import shared_path
from ..sources.tables import table
from ..streaming import events as st
from ..streaming import sinks
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _plain(df: DataFrame, *times: str) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in times else c for c in df.columns])


@query("st1_append_days", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def st1(spark: SparkSession, sf: str) -> DataFrame:
    """The stream appended under day folders, counted from there; every batch arrives twice and is written once."""
    path = shared_path(spark, "event-days")

    def sink(batch: DataFrame, n: int) -> None:
        for _ in range(2):
            sinks.append_days(batch, path, "ts", n)

    st.available(st.read_events(spark, sf), "append", sink, "append-days")
    return spark.read.parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("st2_freshness", "SELECT count(*) AS visible, max(ts) AS newest FROM events")
def st2(spark: SparkSession, sf: str) -> DataFrame:
    """Once what is available has been processed, written rows are visible; the newest time bounds the lag."""
    rows = st.collect_stream(st.read_events(spark, sf).select("event_id", "ts"), "append", "fresh")
    return _plain(rows.agg(F.count(F.lit(1)).alias("visible"), F.max("ts").alias("newest")), "newest")


@query("st3_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def st3(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by hour and label."""
    return _plain(st.collect_stream(st.counted(st.read_events(spark, sf), "1 hour", "event_type"), "complete", "counts"), "start")


@query("st4_distribution", "SELECT CASE WHEN value < 100 THEN 0 ELSE least(13, CAST(floor(log2(value / 100)) AS INT) + 1) END AS bucket, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1")
def st4(spark: SparkSession, sf: str) -> DataFrame:
    """Exponential buckets of durations."""
    e = st.read_events(spark, sf).filter("value IS NOT NULL").groupBy(st.bucket(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return st.collect_stream(e, "complete", "buckets")


@query(
    "st5_alerts",
    "SELECT 'five-minutes' AS alert, time_bucket(INTERVAL 5 MINUTE, ts) AS start, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 2 HAVING count(*) > 0 UNION ALL SELECT 'hour', time_bucket(INTERVAL 1 HOUR, ts), count(*) FROM events WHERE event_type IN ('error', 'purchase') GROUP BY 2 HAVING count(*) > 5",
)
def st5(spark: SparkSession, sf: str) -> DataFrame:
    """Two alerts: any error within five minutes; more than five failures of all kinds within an hour."""
    e = st.read_events(spark, sf)
    short = st.collect_stream(st.counted(e.filter("event_type = 'error'"), "5 minutes"), "complete", "alerts-short").filter("n > 0").withColumn("alert", F.lit("five-minutes"))
    long = st.collect_stream(st.counted(e.filter("event_type IN ('error', 'purchase')"), "1 hour"), "complete", "alerts-long").filter("n > 5").withColumn("alert", F.lit("hour"))
    return _plain(short.unionByName(long).select("alert", "start", "n"), "start")


@query("st6_series", "SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS start, event_type, round(count(*) / 60.0, 6) AS per_second, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1, 2")
def st6(spark: SparkSession, sf: str) -> DataFrame:
    """Rate and exact 95th percentile by minute and service."""
    g = st.read_events(spark, sf).withWatermark("ts", st.LATE).groupBy(F.window("ts", "1 minute").alias("w"), "event_type")
    s = g.agg(F.round(F.count(F.lit(1)) / 60.0, 6).alias("per_second"), F.round(F.percentile("value", 0.95), 6).alias("p95"))
    return _plain(st.collect_stream(s.select(F.col("w.start").alias("start"), "event_type", "per_second", "p95"), "complete", "series"), "start")


@query("st7_once", "SELECT count(*) AS n, count(DISTINCT event_id) AS n_ids FROM events")
def st7(spark: SparkSession, sf: str) -> DataFrame:
    """Repeats of an id within the watermark go."""
    twice = st.read_events(spark, sf)
    twice = twice.unionByName(st.read_events(spark, sf))
    rows = st.collect_stream(st.once(twice, "event_id").select("event_id"), "append", "once")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_ids"))


@query("st8_rerun_refused", "SELECT count(*) FILTER (o_orderkey % 3 <> 0) AS written, count(*) FILTER (o_orderkey % 3 = 0) AS written_again FROM orders")
def st8(spark: SparkSession, sf: str) -> DataFrame:
    """Run ids that were written before are not written again: two thirds come first, then all of them."""
    runs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"), "o_orderstatus")
    path = shared_path(spark, "runs")
    first, again = sinks.append_new(runs.filter("run_id % 3 <> 0"), path, "run_id"), sinks.append_new(runs, path, "run_id")
    return spark.createDataFrame([(first, again)], "written long, written_again long")


@query("snk1_optimistic_commit", "SELECT conv_id AS id, max(turn) AS newest, max(turn) <> 1 AS conflict FROM conversations GROUP BY 1")
def snk1(spark: SparkSession, sf: str) -> DataFrame:
    """Every document written with an expected version of 1: those that moved on are conflicts."""
    current = table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), F.col("turn").alias("version"), F.col("text").alias("body"))
    writes = current.select("id").distinct().select("id", F.lit(1).cast("long").alias("expected"), F.lit("new").alias("body"))
    accepted, conflicts = sinks.commit_versions(current, writes)
    return accepted.select("id", (F.col("version") - 1).alias("newest"), F.lit(False).alias("conflict")).unionByName(conflicts.select("id", "newest", F.lit(True).alias("conflict")))


@query("snk2_write_once", "SELECT true AS first_written, false AS second_written, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders")
def snk2(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "run")
    n = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    first, second = sinks.write_once(n, path), sinks.write_once(n.limit(1), path)
    return spark.read.parquet(path).agg(F.lit(first).alias("first_written"), F.lit(second).alias("second_written"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("total"))


@query("snk3_ledger_append", "SELECT count(DISTINCT l_orderkey) AS n_runs FROM lineitem")
def snk3(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger rows arrive several times; each run is appended once."""
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("run_id"), "l_linestatus")
    path = shared_path(spark, "ledger")
    sinks.append_new(rows, path, "run_id")
    sinks.append_new(rows, path, "run_id")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_runs"))


@query("snk4_ledger_rows", "SELECT o_orderkey AS run_id, o_orderstatus AS status, o_orderpriority AS environment, o_orderdate AS completed_at FROM orders")
def snk4(spark: SparkSession, sf: str) -> DataFrame:
    m = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("environment"), F.col("o_orderdate").alias("completed_at"))
    return sinks.ledger_rows(table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"), m.alias("manifest"))).select("run_id", "status", "environment", "completed_at")


@query("snk5_day_partitions", "SELECT count(*) FILTER (CAST(ts AS DATE) >= DATE '2024-01-15') AS n_left FROM events")
def snk5(spark: SparkSession, sf: str) -> DataFrame:
    """Day folders before a date are expired; a read of the rest is pruned to its folders."""
    path = shared_path(spark, "days")
    sinks.append_days(table(spark, sf, "events").select("event_id", "ts"), path, "ts")
    sinks.expire_days(spark, path, "2024-01-15")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_left"))


@query("snk6_notifications", "SELECT conv_id AS id, max(turn) AS version_id FROM conversations GROUP BY 1")
def snk6(spark: SparkSession, sf: str) -> DataFrame:
    """Notifications carry id and version only."""
    return table(spark, sf, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.max("turn").alias("version_id"))


@query("snk8_jsonl", "SELECT r_regionkey, r_name FROM region")
def snk8(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines and back."""
    path = shared_path(spark, "jsonl")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    r.coalesce(1).write.json(path)
    return spark.read.schema(r.schema).json(path)


@query("snk10_persisted_version", "SELECT conv_id, turn, regexp_extract('Bundle/' || conv_id || '/_history/' || turn, '/_history/([^/]+)$', 1) AS version FROM conversations")
def snk10(spark: SparkSession, sf: str) -> DataFrame:
    location = F.concat(F.lit("Bundle/"), "conv_id", F.lit("/_history/"), "turn")
    return table(spark, sf, "conversations").select("conv_id", "turn", sinks.persisted_version(location).alias("version"))


@query("a_running_share", "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) / sum(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS share FROM orders")
def running(spark: SparkSession, sf: str) -> DataFrame:
    own = Window.partitionBy("o_custkey")
    upto = own.orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return table(spark, sf, "orders").select("o_orderkey", F.round(F.sum("o_totalprice").over(upto) / F.sum("o_totalprice").over(own), 6).alias("share"))
