"""Bundles and Word files: written from the tables, read back, checked."""

from __future__ import annotations

import hashlib
import hmac
import os
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, xhtml
from ..shipping import arrow_udf
from ..sources import bundles
from ..sources.tables import table
from .edges_sql import normal
from .model import SECTIONS_SQL
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _bundles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as bundles (src9: a synthetic fixture source made from the tables)."""
    d = table(spark, sf, "documents").filter("text IS NOT NULL")
    return d.select(F.col("doc_id").alias("bundle_id"), F.lit(1).alias("version_id"), bundles.as_bundle(F.col("doc_id"), F.col("text")).alias("json"))


@query("src12_read_bundle", f"WITH {SECTIONS_SQL} SELECT doc_id AS bundle_id, 'section[' || pos || ']' AS path, 'Section ' || pos AS title, sha256('<div>' || body || '</div>') AS div_sha256 FROM sections")
def src12(spark: SparkSession, sf: str) -> DataFrame:
    """Bundles parsed strictly and their section trees flattened."""
    return bundles.flatten(_bundles(spark, sf)).select("bundle_id", "path", "title", F.sha2("div", 256).alias("div_sha256"))


@query(
    "j6_bundle_references",
    "SELECT doc_id AS bundle_id, 'urn:product:' || doc_id AS reference, doc_id % 3 <> 1 AS resolved FROM documents WHERE text IS NOT NULL",
)
def j6(spark: SparkSession, sf: str) -> DataFrame:
    """References inside bundles, and whether an entry of the bundle resolves them: two of three bundles hold the
    product that their composition names, the others hold another one."""
    b = _bundles(spark, sf)
    named = F.concat(F.lit("urn:product:"), (F.col("bundle_id") + F.when(F.col("bundle_id") % 3 == 1, 1).otherwise(0)).cast("string"))
    product = F.concat(F.lit(',{"fullUrl":"'), named, F.lit('","resource":{"resourceType":"MedicinalProductDefinition"}}]}'))
    whole = b.withColumn("json", F.concat(F.expr("left(json, length(json) - 2)"), product))
    return bundles.references(whole)


@query("f15_bundle_leaves", f"WITH {SECTIONS_SQL} SELECT doc_id AS bundle_id, 5 + 3 * count(*) AS n_strings FROM sections GROUP BY 1")
def f15(spark: SparkSession, sf: str) -> DataFrame:
    """Every string of a bundle with its path, counted."""
    return _bundles(spark, sf).select("bundle_id", F.size(bundles.leaves(F.col("json"))).cast("long").alias("n_strings"))


@query("x9_narrative", f"WITH {SECTIONS_SQL} SELECT doc_id, pos, replace(replace(replace(body, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS markup FROM sections")
def x9(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs written as narrative markup."""
    from .model import sections

    escaped = F.replace(F.replace(F.replace("body", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return sections(spark, sf).select("doc_id", "pos", escaped.alias("markup"))


@query(
    "n4_bullets",
    "SELECT doc_id, sha256(CASE doc_id % 4 WHEN 0 THEN 'x' || chr(10) || '  a' || chr(10) || 'b' WHEN 1 THEN 'x' || chr(10) || '• a' || chr(9) || 'b' WHEN 2 THEN '• a' || chr(10) || ' •b' ELSE 'x' || chr(10) || '  a 2 • 10' END || source) AS sha FROM documents WHERE source IS NOT NULL",
)
def n4(spark: SparkSession, sf: str) -> DataFrame:
    """Bullets at line starts become spaces: not on a line with a tab, not at the start of the text, not without
    white space behind, not inside a line."""
    rows = F.array(F.lit("x\n• a\nb"), F.lit("x\n• a\tb"), F.lit("• a\n •b"), F.lit("x\n • a 2 • 10"))
    d = table(spark, sf, "documents").filter("source IS NOT NULL")
    c = F.concat(F.element_at(rows, (F.col("doc_id") % 4 + 1).cast("int")), "source")
    return d.select("doc_id", F.sha2(text.plain_bullets(c), 256).alias("sha"))


@query(
    "n8_idempotence",
    f"WITH n AS (SELECT doc_id, {normal('text')} AS once FROM documents) SELECT doc_id, sha256({normal('once')}) AS twice, sha256(once) = sha256({normal('once')}) AS idempotent FROM n",
)
def n8(spark: SparkSession, sf: str) -> DataFrame:
    """Normalising twice changes nothing, document by document."""
    once = table(spark, sf, "documents").select("doc_id", text.normalize(F.col("text")).alias("once"))
    both = once.select("doc_id", F.sha2("once", 256).alias("once"), F.sha2(text.normalize(F.col("once")), 256).alias("twice"))
    return both.select("doc_id", "twice", (F.col("once") == F.col("twice")).alias("idempotent"))


def principal(user: str, key: bytes) -> str:
    """Opaque name of a person: keyed hash of the case-folded compatibility form."""
    return hmac.new(key, unicodedata.normalize("NFKC", user).casefold().encode(), hashlib.sha256).hexdigest()


def principals(key: bytes):
    """A column function: opaque names under a key, which the caller gives (it is in no code or plan text)."""

    def named(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda u: principal(u, key), na_action="ignore")

    return arrow_udf(named, "string")


@query("p26_principals")
def p26(spark: SparkSession, sf: str) -> DataFrame:
    """Opaque principals of customers. The key comes from the session (quillstone.principal.key); without one a
    key is drawn for this query alone, so names cannot be compared between runs."""
    key = spark.conf.get("quillstone.principal.key", None)
    return table(spark, sf, "customer").select("c_custkey", principals(key.encode() if key else os.urandom(32))(F.col("c_name")).alias("principal"))


@query("p21_plain_characters")
def p21(spark: SparkSession, sf: str) -> DataFrame:
    """Characters of pages without their markup."""
    n = F.aggregate(xhtml.paragraphs(F.col("html")), F.lit(0), lambda a, x: a + F.length(x))
    return table(spark, sf, "pages").select("page_id", n.cast("long").alias("n_characters"))
