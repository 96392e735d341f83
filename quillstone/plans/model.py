"""Stand-ins for documents, sections, spans and versions on the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import table


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pos, path, body: the lines of a document are its sections, in order."""
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "body"))
    return lines.select("doc_id", "pos", F.format_string("section[%d]", "pos").alias("path"), "body")


SECTIONS_SQL = """
sections AS (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INT) AS pos,
    unnest(string_split(text, chr(10))) AS body FROM documents WHERE text IS NOT NULL)"""


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, pos, s, e: where each section stands in its document, in code points."""
    order = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    narrow = sections(spark, sf_dir).select("doc_id", "pos", F.length("body").alias("n"))  # no text goes through the window
    placed = narrow.withColumn("e", (F.sum(F.col("n") + 1).over(order) - 1).cast("int"))
    return placed.select("doc_id", "pos", (F.col("e") - F.col("n")).alias("s"), "e")


SPANS_SQL = (
    SECTIONS_SQL
    + """,
spans AS (SELECT doc_id, pos, CAST(sum(length(body) + 1) OVER d - length(body) - 1 AS INT) AS s, CAST(sum(length(body) + 1) OVER d - 1 AS INT) AS e
    FROM sections WINDOW d AS (PARTITION BY doc_id ORDER BY pos))"""
)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bundle_id, version_id, role, body: a conversation is a document, its turns are its versions."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("bundle_id"), F.col("turn").alias("version_id"), "role", F.col("text").alias("body"))
