"""Event streams: sources, deduplication, metrics, alerts and sinks.

State is bounded by a watermark (ten minutes by default; the time that late rows may come). Everything
is triggered by what is available, so a run ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..scratch import shared_path
from ..sources.tables import table

LATE = "10 minutes"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files; times are instants, as watermarks need them."""
    kind: StructType = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(kind).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", "false").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def available(stream: DataFrame, mode: str, sink: Callable[[DataFrame, int], None], name: str) -> None:
    """Run the stream over what is there; each batch goes to ``sink``."""
    spark = stream.sparkSession
    run = stream.writeStream.outputMode(mode).option("checkpointLocation", shared_path(spark, f"{name}-state")).foreachBatch(sink).trigger(availableNow=True).start()
    run.awaitTermination()


def collect_stream(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Rows of a finished stream, from a table that each batch is written to under its own number, so a
    batch that runs twice is written once. Complete mode keeps the last batch."""
    spark = stream.sparkSession
    path = shared_path(spark, name)
    last = [-1]

    def sink(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={n}")
        last[0] = max(last[0], n)

    available(stream, mode, sink, name)
    kind = stream.schema
    if last[0] < 0:
        return spark.createDataFrame([], kind)
    if mode == "complete":
        return spark.read.schema(kind).parquet(f"{path}/batch={last[0]}")
    return spark.read.schema(kind).option("basePath", path).parquet(path).select(*kind.names)


def counted(events: DataFrame, width: str, *labels: str) -> DataFrame:
    """Rows by tumbling window and labels."""
    g = events.withWatermark("ts", LATE).groupBy(F.window("ts", width).alias("w"), *labels).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("start"), *labels, "n")


def bucket(value: Column, scale: float = 100.0, buckets: int = 12) -> Column:
    """Exponential bucket of factor 2: 0 below scale, the last one open."""
    return F.when(value < scale, 0).otherwise(F.least(F.lit(buckets + 1), (F.floor(F.log2(value / scale)) + 1).cast("int")))


def once(events: DataFrame, key: str) -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark("ts", LATE).dropDuplicatesWithinWatermark([key])
