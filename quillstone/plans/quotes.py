"""Quotes: find passages verbatim in stored documents, as the query tools answer it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quoting, text
from ..operators import search
from ..sources.tables import table
from .edges_sql import normal, places
from .model import SECTIONS_SQL, sections
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", text.normalize(F.col("text")).alias("quote"))


VERIFY_QUOTE_SQL = f"""
WITH d AS (SELECT doc_id AS b, {normal('text')} AS body FROM documents), q AS (SELECT item_id AS a, {normal('text')} AS quote FROM benchmark),
h AS (SELECT a, b, body, min(s) AS s FROM {places('SELECT a, b, body, quote FROM d JOIN q ON contains(body, quote)')} GROUP BY 1, 2, 3),
f AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY b) AS r, count(*) OVER (PARTITION BY a) AS n FROM h)
SELECT q.a AS item_id, CASE WHEN coalesce(q.quote, '') = '' THEN 'invalid-request' WHEN f.b IS NULL THEN 'no-match' ELSE 'match' END AS outcome, f.b AS doc_id,
  CAST(f.s AS BIGINT) AS span_start, CAST(f.s + length(q.quote) AS BIGINT) AS span_end, CAST(coalesce(f.n, 0) AS BIGINT) AS n_documents,
  sha256(q.quote) AS quote_sha256, sha256(f.body) AS document_sha256
FROM q LEFT JOIN f ON q.a = f.a AND f.r = 1
"""


@query("verify_quote", VERIFY_QUOTE_SQL)
def verify_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark passage looked up in every document, both normalised: the first document that holds
    it at safe edges, its code-point span there, how many documents hold it, and the hashes of both texts.

    Candidates come from an equi-join on hashed words; only these are normalised again and searched.
    """
    quotes = _passages(spark, sf_dir)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    asked = quotes.filter("quote <> ''")
    hit = search.located(docs, ["doc_id"], "body", asked, "item_id", "quote", text.normalize)
    at = hit.select("item_id", F.struct("doc_id", "start", F.sha2("body", 256).alias("sha")).alias("at"))
    first = at.groupBy("item_id").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("n_documents"))
    valid = quoting.may_be_asked(F.col("quote"))
    return quotes.join(first, "item_id", "left").select(
        "item_id",
        F.when(~valid, "invalid-request").when(F.col("at").isNull(), "no-match").otherwise("match").alias("outcome"),
        F.col("at.doc_id").alias("doc_id"),
        F.col("at.start").cast("long").alias("span_start"),
        (F.col("at.start") + F.length("quote")).cast("long").alias("span_end"),
        F.coalesce("n_documents", F.lit(0)).cast("long").alias("n_documents"),
        F.sha2("quote", 256).alias("quote_sha256"),
        F.col("at.sha").alias("document_sha256"),
    )


def answer_quotes(requests: DataFrame, parts: DataFrame, entitled: DataFrame) -> DataFrame:
    """The quote tool. requests: request_id, bundle_id, source_key (null: any), quote. parts: bundle_id, pos,
    path, body (the sections with a narrative). entitled: bundle_id.

    request_id, outcome, audit_outcome, sections_searched, path, start, end, quote_sha256, text_sha256.
    Entitlement is decided before the quote is looked at, and a refusal looks like a missing document to
    the caller; a quote that shows nothing, or holds a forbidden or reserved character, is an invalid
    request; the first section in document order with an accepted place is the match; sections searched
    counts the candidates, whether or not the search stopped early.
    """
    known = parts.select("bundle_id").distinct().withColumn("exists", F.lit(True))
    may = entitled.select("bundle_id").distinct().withColumn("may", F.lit(True))
    asked = requests.withColumn("quote", text.normalize(F.col("quote"))).join(may, "bundle_id", "left").join(known, "bundle_id", "left")
    gate = F.when(F.col("may").isNull(), "not-entitled").when(~quoting.may_be_asked(F.col("quote")), "invalid-request").when(F.col("exists").isNull(), "document-not-found")
    asked = asked.select("request_id", "bundle_id", "source_key", "quote", gate.alias("gate"))
    scope = parts.select("bundle_id", "pos", "path", "body").join(asked.filter("gate IS NULL").select("request_id", "bundle_id", "source_key", "quote"), "bundle_id")
    scope = scope.filter(F.col("source_key").isNull() | (F.col("source_key") == F.col("path"))).withColumn("body", text.normalize(F.col("body")))
    held = F.contains("body", "quote")
    spans = scope.withColumn("span", quoting.locate(F.when(held, F.col("body")), F.when(held, F.col("quote"))))
    place = F.when(F.col("span.start").isNotNull(), F.struct("pos", "path", F.col("span.start").alias("start"), F.col("span.end").alias("end"), F.sha2("body", 256).alias("sha")))
    found = spans.groupBy("request_id").agg(F.count(F.lit(1)).alias("searched"), F.min(place).alias("at"))
    out = asked.join(found, "request_id", "left")
    missing = F.col("gate").isNull() & F.col("searched").isNull()
    outcome = F.coalesce("gate", F.when(missing, "section-not-found"), F.when(F.col("at").isNull(), "no-match"), F.lit("match"))
    answered = F.col("gate").isNull() & ~missing
    return out.select(
        "request_id", F.when(outcome == "not-entitled", "document-not-found").otherwise(outcome).alias("outcome"), outcome.alias("audit_outcome"),
        F.when(answered, F.col("searched")).alias("sections_searched"), F.col("at.path").alias("path"), F.col("at.start").alias("start"), F.col("at.end").alias("end"),
        F.when(answered, F.sha2("quote", 256)).alias("quote_sha256"), F.col("at.sha").alias("text_sha256"),
    )


#: Requests made from the tables: words of a document's second line asked of the document itself; every
#: fifth asks one section, every seventh quotes nothing, every ninth names a document that does not exist.
REQUESTS_SQL = f"""{SECTIONS_SQL}, req AS (SELECT doc_id AS request_id, CASE WHEN doc_id % 9 = 4 THEN doc_id + 100000000 ELSE doc_id END AS bundle_id,
  CASE WHEN doc_id % 5 = 0 THEN 'section[1]' END AS source_key, CASE WHEN doc_id % 7 = 3 THEN ' ' ELSE array_to_string(string_split(body, ' ')[2:5], ' ') END AS quote FROM sections WHERE pos = 1)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = sections(spark, sf_dir).filter("pos = 1")
    d = F.col("doc_id")
    quote = F.array_join(F.slice(F.split("body", " "), 2, 4), " ")
    return own.select(
        d.alias("request_id"), F.when(d % 9 == 4, d + 100000000).otherwise(d).alias("bundle_id"), F.when(d % 5 == 0, "section[1]").alias("source_key"),
        F.when(d % 7 == 3, " ").otherwise(quote).alias("quote"),
    )


@query(
    "t4_verify_quote",
    f"""WITH {REQUESTS_SQL}, may AS (SELECT DISTINCT doc_id AS bundle_id FROM labels WHERE quality = 1),
n AS (SELECT request_id, req.bundle_id, source_key, {normal('quote')} AS quote, may.bundle_id IS NOT NULL AS entitled, EXISTS (SELECT 1 FROM sections s WHERE s.doc_id = req.bundle_id) AS known FROM req LEFT JOIN may USING (bundle_id)),
g AS (SELECT *, CASE WHEN NOT entitled THEN 'not-entitled' WHEN coalesce(quote, '') = '' THEN 'invalid-request' WHEN NOT known THEN 'document-not-found' END AS gate FROM n),
sc AS (SELECT g.request_id, g.quote, s.pos, {normal('s.body')} AS body FROM g JOIN sections s ON s.doc_id = g.bundle_id WHERE gate IS NULL AND (source_key IS NULL OR source_key = 'section[' || pos || ']')),
c AS (SELECT request_id, count(*) AS searched FROM sc GROUP BY 1),
h AS (SELECT a AS request_id, arg_min(b, (b, s)) AS pos, arg_min(s, (b, s)) AS s, arg_min(sha256(body), (b, s)) AS sha FROM {places('SELECT request_id AS a, pos AS b, body, quote FROM sc WHERE contains(body, quote)')} GROUP BY 1)
SELECT g.request_id, CASE coalesce(gate, CASE WHEN searched IS NULL THEN 'section-not-found' WHEN h.pos IS NULL THEN 'no-match' ELSE 'match' END) WHEN 'not-entitled' THEN 'document-not-found' ELSE coalesce(gate, CASE WHEN searched IS NULL THEN 'section-not-found' WHEN h.pos IS NULL THEN 'no-match' ELSE 'match' END) END AS outcome,
  coalesce(gate, CASE WHEN searched IS NULL THEN 'section-not-found' WHEN h.pos IS NULL THEN 'no-match' ELSE 'match' END) AS audit_outcome, searched AS sections_searched, 'section[' || h.pos || ']' AS path,
  CAST(h.s AS INT) AS start, CAST(h.s + length(quote) AS INT) AS end, CASE WHEN gate IS NULL AND searched IS NOT NULL THEN sha256(quote) END AS quote_sha256, h.sha AS text_sha256
FROM g LEFT JOIN c USING (request_id) LEFT JOIN h USING (request_id)""",
)
def t4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote requests answered document by document: a shuffle by document, and the search inside it."""
    entitled = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").alias("bundle_id"))
    parts = sections(spark, sf_dir).withColumnRenamed("doc_id", "bundle_id")
    return answer_quotes(requests(spark, sf_dir), parts, entitled)


@query(
    "j12_quote_sections",
    f"""WITH {SECTIONS_SQL}, q AS (SELECT item_id AS a, {normal('text')} AS quote FROM benchmark),
h AS (SELECT a, min(b) AS b FROM {places(f"SELECT a, (doc_id, pos) AS b, {normal('body')} AS body, quote FROM sections JOIN q ON contains({normal('body')}, quote)")} GROUP BY 1)
SELECT a AS item_id, struct_extract(b, 1) AS doc_id, struct_extract(b, 2) AS pos FROM h""",
)
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first section, in document order, that holds a whole passage at safe edges."""
    hit = search.located(sections(spark, sf_dir).select("doc_id", "pos", "body"), ["doc_id", "pos"], "body", _passages(spark, sf_dir).filter("quote <> ''"), "item_id", "quote", text.normalize)
    return hit.groupBy("item_id").agg(F.min(F.struct("doc_id", "pos")).alias("at")).select("item_id", "at.doc_id", "at.pos")


@query(
    "q1_locate_quote",
    f"""WITH d AS (SELECT doc_id AS b, {normal('text')} AS body FROM documents), q AS (SELECT item_id AS a, {normal('text')} AS quote FROM benchmark)
SELECT a AS item_id, b AS doc_id, CAST(min(s) AS INT) AS start, CAST(min(s) + max(length(quote)) AS INT) AS end FROM {places('SELECT a, b, body, quote FROM d JOIN q ON contains(body, quote)')} GROUP BY 1, 2""",
)
def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of passage and document with the span of its first accepted place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
    return search.located(docs, ["doc_id"], "body", _passages(spark, sf_dir).filter("quote <> ''"), "item_id", "quote", text.normalize).select("item_id", "doc_id", "start", "end")
