"""Documents of an authority as files, held against its index of hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fetch(spark: SparkSession, folder: str, index: DataFrame, name: str) -> DataFrame:
    """name, outcome, content: files below a folder against index (name, pin). ``name`` is a pattern whose group
    is a document's name in its path. A file without entry is not-indexed, one with other bytes pin-mismatch;
    only trusted content is returned."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    named = files.select(F.regexp_extract("path", name, 1).alias("name"), "content").filter("name <> ''")
    joined = named.join(index, "name", "left")
    outcome = F.when(F.col("pin").isNull(), "not-indexed").when(F.sha2("content", 256) != F.col("pin"), "pin-mismatch").otherwise("trusted")
    return joined.select("name", outcome.alias("outcome"), F.when(outcome == "trusted", F.col("content")).alias("content"))
