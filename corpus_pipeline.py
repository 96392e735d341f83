"""The corpus pipeline: language ID, line dedup, near-duplicate removal, mixing, encoding.

Each stage works on all rows that the one before kept; all but the last return the columns of
documents. Stages do not depend on each other's internals: each takes and returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import bpe, chosenpath, langid, lines, mixing
from quillstone.llm.common import forget, materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are no text of a known language go: no letters, or too far from every centroid.
    If no row has a label there are no centroids, and only those without letters (or text) go.
    lang becomes the prediction where the document has none."""
    named = langid.annotate(docs, langid.fit(docs)).filter(~F.col("_lang_rejected"))
    return named.select(*[F.coalesce(named[c], named["_lang_pred"]).alias(c) if c == "lang" else named[c] for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line windows leave the texts; documents that they make up whole go. n_chars follows the text."""
    cut = lines.dedup_lines(docs)
    emptied = F.col("_removed_lines").isNotNull() & (F.trim(F.col("text")) == "")
    kept = cut.filter(~F.coalesce(emptied, F.lit(False)))
    length = F.when(F.col("_removed_lines").isNull(), kept["n_chars"]).otherwise(F.length("text").cast("long")) if "n_chars" in docs.columns else None
    return kept.select(*[length.alias(c) if c == "n_chars" else kept[c] for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id stays. Each row is decided by
    itself: rows that share a doc_id are documents of their own, and of equal rows one stays."""
    return chosenpath.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the digest of what they decode to."""
    return bpe.round_trip(docs).select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", encode),
]
#: Cube sampling, chosen paths and BPE have no SQL form; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            forget(before)  # the stage that read it has been written
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
