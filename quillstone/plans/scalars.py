"""Scalar functions over the tables: hashes, normalisation, quotes, patterns and extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing, quoting, text, xhtml
from ..sources.tables import table
from .edges_sql import FORBIDDEN, WHITE, normal
from .model import SECTIONS_SQL, sections
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


@query("h1_sha256", "SELECT doc_id, sha256(text) AS sha FROM documents")
def h1(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", hashing.sha256_text(F.col("text")).alias("sha"))


@query("h2_canonical_json")
def h2(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical text of the events' properties."""
    return table(spark, sf, "events").select("event_id", hashing.canonical_json(F.col("props")).alias("canonical"))


@query("h3_canonical_hash")
def h3(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.sha2(hashing.canonical_json(F.col("props")), 256).alias("sha"))


@query("h4_stable_uuid", "WITH h AS (SELECT p_partkey, sha256('part:' || p_name) AS h FROM part) SELECT p_partkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-a' || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM h")
def h4(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", hashing.stable_uuid("part", F.col("p_name")).alias("id"))


@query("h5_crc32c")
def h5(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", hashing.crc32c(F.col("p_name")).alias("crc"))


@query("h6_edit_id", "SELECT p_partkey, substr(sha256(encode(p_name) || '\\x00'::BLOB || encode(p_type)), 1, 12) AS edit_id FROM part")
def h6(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", hashing.edit_id(F.col("p_name"), F.col("p_type")).alias("edit_id"))


@query("h7_head_name", "SELECT o_orderkey, o_orderstatus || '/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS object FROM orders")
def h7(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", hashing.head_name(F.col("o_orderstatus"), F.col("o_orderkey")).alias("object"))


@query("h9_report_hash", "SELECT o_orderkey, sha256('{\"key\":' || o_orderkey || ',\"status\":\"' || o_orderstatus || '\"}') AS report_hash FROM orders")
def h9(spark: SparkSession, sf: str) -> DataFrame:
    """A report's hash is taken over the report without it."""
    return table(spark, sf, "orders").select("o_orderkey", F.sha2(F.to_json(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))), 256).alias("report_hash"))


@query("n1_invisible", "SELECT doc_id, length(regexp_replace(text, '[­​﻿⁠]', '', 'g')) AS n FROM documents")
def n1(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.length(text.drop_invisible(F.col("text"))).cast("long").alias("n"))


@query("n2_ligatures", "SELECT doc_id, sha256(replace(replace(text, 'ﬁ', 'fi'), 'ﬂ', 'fl')) AS sha FROM documents")
def n2(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.expand_ligatures(F.col("text")), 256).alias("sha"))


@query("n3_composition", "SELECT doc_id, sha256(nfc_normalize(text)) AS sha FROM documents")
def n3(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.compose(F.col("text")), 256).alias("sha"))


@query("n5_collapse", f"SELECT doc_id, sha256(trim(regexp_replace(text, '[{WHITE}]+', ' ', 'g'))) AS sha FROM documents")
def n5(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.collapse(F.col("text")), 256).alias("sha"))


@query("n_normalize", f"SELECT doc_id, sha256({normal('text')}) AS sha FROM documents")
def n_all(spark: SparkSession, sf: str) -> DataFrame:
    """The whole normalisation (the tables hold no bullets or ligatures: those are tested by hand-made rows)."""
    return table(spark, sf, "documents").select("doc_id", F.sha2(text.normalize(F.col("text")), 256).alias("sha"))


@query("n6_forbidden", f"SELECT doc_id, regexp_matches(text, '[{FORBIDDEN}]') AS refused FROM documents")
def n6(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.forbidden_at(F.col("text")).isNotNull().alias("refused"))


@query("n9_template_collapse", "SELECT p_partkey, regexp_replace(p_type, '[ \t]+', ' ', 'g') AS form FROM part")
def n9(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", text.collapse_template(F.col("p_type")).alias("form"))


@query("x1_lines_as_xhtml", f"WITH {SECTIONS_SQL} SELECT doc_id, pos, sha256(chr(10) || body || chr(10)) AS sha FROM sections WHERE NOT regexp_matches(body, '[<>&]')")
def x1b(spark: SparkSession, sf: str) -> DataFrame:
    """Sections written as narrative and read back give their text."""
    s = sections(spark, sf).filter(~F.col("body").rlike("[<>&]"))
    div = F.concat(F.lit('<div xmlns="http://www.w3.org/1999/xhtml">'), F.col("body"), F.lit("</div>"))
    return s.select("doc_id", "pos", F.sha2(xhtml.xhtml_to_text(div)["text"], 256).alias("sha"))


@query("src13_lenient_text")
def src13(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of pages read leniently."""
    return table(spark, sf, "pages").select("page_id", F.size(xhtml.paragraphs(F.col("html"))).alias("n_paragraphs"))


@query("x8_contrast", "WITH c AS (SELECT p_partkey, [p_size * 5 % 256, p_partkey % 256, 200] AS a FROM part), l AS (SELECT p_partkey, list_transform(a, lambda v: CASE WHEN v / 255.0 <= 0.04045 THEN v / 255.0 / 12.92 ELSE pow((v / 255.0 + 0.055) / 1.055, 2.4) END) AS v FROM c) SELECT p_partkey, round(1.05 / (0.2126 * v[1] + 0.7152 * v[2] + 0.0722 * v[3] + 0.05), 6) AS contrast FROM l")
def x8(spark: SparkSession, sf: str) -> DataFrame:
    """Contrast of part colours with white."""
    rgb = [(F.col("p_size") * 5 % 256).cast("double"), (F.col("p_partkey") % 256).cast("double"), F.lit(200.0)]
    return table(spark, sf, "part").select("p_partkey", F.round(text.contrast(rgb, [F.lit(255.0)] * 3), 6).alias("contrast"))


@query("q3_chunks")
def q3(spark: SparkSession, sf: str) -> DataFrame:
    """Documents cut into chunks of at most 2,000 UTF-16 units at spaces."""
    return table(spark, sf, "documents").select("doc_id", F.posexplode(quoting.chunks(F.coalesce("text", F.lit("")))).alias("n", "c")).select("doc_id", "n", "c.start", "c.end")


@query("p5_tokens", "SELECT conv_id, turn, len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+|\\s+|[^\\p{L}\\p{N}_\\s]')) AS n_tokens, array_to_string(regexp_extract_all(text, '[\\p{L}\\p{N}_]+|\\s+|[^\\p{L}\\p{N}_\\s]'), '') = text AS lossless FROM conversations WHERE text IS NOT NULL")
def p5(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of a text, and that joined they give it back."""
    t = text.tokens(F.col("text"))
    return table(spark, sf, "conversations").filter("text IS NOT NULL").select("conv_id", "turn", F.size(t).cast("long").alias("n_tokens"), (F.array_join(t, "") == F.col("text")).alias("lossless"))


@query("p6_segments")
def p6(spark: SparkSession, sf: str) -> DataFrame:
    """Difference of consecutive versions as kept, inserted and deleted segments."""
    after = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    c = table(spark, sf, "conversations").withColumn("after", after).filter("text IS NOT NULL AND after IS NOT NULL")
    s = quoting.segments(F.col("text"), F.col("after"))
    return c.select("conv_id", "turn", s.alias("s")).select("conv_id", "turn", F.size("s").alias("n_segments"), F.size(F.filter("s", lambda x: x["kind"] == "i")).alias("n_inserted"))


@query("p10_days_late", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'P' THEN NULL ELSE greatest(0, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02')) END AS days_late FROM orders")
def p10(spark: SparkSession, sf: str) -> DataFrame:
    late = F.greatest(F.lit(0), F.datediff(F.lit("1998-08-02").cast("date"), F.col("o_orderdate").cast("date")))
    return table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "P", None).otherwise(late).cast("long").alias("days_late"))


@query("p11_numbers", "SELECT p_partkey, array_to_string(regexp_extract_all(p_brand || '/' || p_size, '[0-9]+'), ',') AS numbers FROM part")
def p11(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.regexp_extract_all(F.concat_ws("/", "p_brand", "p_size"), F.lit("[0-9]+"), F.lit(0)), ",").alias("numbers"))


@query("p12_causes", "SELECT left(regexp_replace(event_type || ' failed at ' || event_id, '[0-9]+', 'N', 'g'), 80) AS cause, count(*) AS n FROM events GROUP BY 1")
def p12(spark: SparkSession, sf: str) -> DataFrame:
    """Messages without what varies, counted."""
    message = F.concat_ws(" failed at ", "event_type", F.col("event_id").cast("string"))
    return table(spark, sf, "events").groupBy(text.cause(message).alias("cause")).agg(F.count(F.lit(1)).alias("n"))


@query("p20_subject", "SELECT c_custkey, regexp_replace(c_name, '^Customer#', '') AS subject FROM customer")
def p20(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", F.regexp_replace("c_name", "^Customer#", "").alias("subject"))


@query("p22_spaced", "SELECT doc_id, sha256(regexp_replace(text, '[ \t\r\n\f\v]', ' ', 'g')) AS sha FROM documents")
def p22(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.sha2(F.regexp_replace("text", "[ \\t\\r\\n\\f\\x0B]", " "), 256).alias("sha"))


