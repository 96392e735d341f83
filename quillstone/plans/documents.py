"""Reading stored documents: point reads, versions, sections, products, provenance, entitlement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import joins, windows
from ..sources.tables import table
from .gates import checked_limit
from .model import SECTIONS_SQL, sections, versions
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql

LATEST_SQL = "v AS (SELECT conv_id AS bundle_id, turn AS version_id, role, text AS body FROM conversations), latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bundle_id ORDER BY version_id DESC NULLS LAST, role) r FROM v) WHERE r = 1)"


@query("src1_read_current", f"WITH {LATEST_SQL} SELECT bundle_id, version_id, role, body FROM latest WHERE bundle_id = 7")
def src1(spark: SparkSession, sf: str) -> DataFrame:
    """The current version of one document: the filter reaches the scan, the rank sees one document."""
    return windows.latest(versions(spark, sf).filter("bundle_id = 7"), ["bundle_id"], "version_id", "role")


@query("src2_read_version", "SELECT conv_id AS bundle_id, turn AS version_id, role, text AS body FROM conversations WHERE conv_id = 7 AND turn = 1")
def src2(spark: SparkSession, sf: str) -> DataFrame:
    """A named version."""
    return versions(spark, sf).filter("bundle_id = 7 AND version_id = 1")


@query("src3_read_provenance", "SELECT event_id, user_id, ts, event_type FROM events WHERE event_id = 11")
def src3(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter("event_id = 11").select("event_id", "user_id", "ts", "event_type")


@query("src4_provenance_page", "SELECT event_id, user_id, ts FROM events WHERE user_id = 3 ORDER BY ts DESC, event_id LIMIT 20")
def src4(spark: SparkSession, sf: str) -> DataFrame:
    """The newest page of twenty entries of one target."""
    return table(spark, sf, "events").filter("user_id = 3").orderBy(F.desc("ts"), "event_id").limit(20).select("event_id", "user_id", "ts")


BUDGET = 6000


@query(
    "src5_hash_pinned_read",
    f"""WITH p AS (SELECT doc_id // 3 AS submission, doc_id, text, CASE WHEN doc_id % 10 = 7 THEN repeat('0', 64) ELSE sha256(text) END AS pin, sum(octet_length(encode(text))) OVER (PARTITION BY doc_id // 3 ORDER BY doc_id) AS used FROM documents WHERE text IS NOT NULL)
SELECT submission, doc_id, CASE WHEN used > {BUDGET} THEN 'too-large' WHEN sha256(text) <> pin THEN 'hash-mismatch' ELSE 'trusted' END AS outcome FROM p""",
)
def src5(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of submissions (three documents each) against their pins: parts share one byte budget and are read
    in order, so what comes after it is used up is not looked at; what is read is trusted only if it hashes to
    its pin. Lengths and digests are taken in the scan: no text is shuffled, and pins are digests."""
    docs = table(spark, sf, "documents").filter("text IS NOT NULL")
    parts = docs.select(F.expr("doc_id DIV 3").alias("submission"), "doc_id", F.octet_length("text").alias("n"), F.sha2("text", 256).alias("sha"))
    pin = F.when(F.col("doc_id") % 10 == 7, F.lit("0" * 64)).otherwise(F.col("sha"))
    used = F.sum("n").over(Window.partitionBy("submission").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return parts.withColumns({"pin": pin, "used": used}).select("submission", "doc_id", F.when(F.col("used") > BUDGET, "too-large").when(F.col("sha") != F.col("pin"), "hash-mismatch").otherwise("trusted").alias("outcome"))


@query(
    "src6_strict_json",
    "SELECT event_id, json_valid(props) AND event_id % 7 <> 3 AND event_id % 11 <> 5 AS readable FROM events",
)
def src6(spark: SparkSession, sf: str) -> DataFrame:
    """Properties read strictly: what is no JSON, or names a key of an object twice, is refused. Every seventh
    row is given a second key of a name here, every eleventh a missing brace."""
    e, n = table(spark, sf, "events"), F.col("event_id")
    twice = F.concat(F.lit('{"x": {"k": 1, "k": 2}, "y": '), "props", F.lit("}"))
    given = F.when(n % 7 == 3, twice).when(n % 11 == 5, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    return e.select("event_id", hashing.canonical_json(given).isNotNull().alias("readable"))


@query("src15_json_lines", "SELECT doc_id, lang, n_chars FROM documents")
def src15(spark: SparkSession, sf: str) -> DataFrame:
    """Records written to JSON lines and scanned back with a declared schema."""
    rows = table(spark, sf, "documents").select(F.to_json(F.struct("doc_id", "lang", "n_chars")).alias("line"))
    return rows.select(F.from_json("line", "doc_id long, lang string, n_chars long", {"mode": "FAILFAST"}).alias("r")).select("r.*")


LISTED = 100_000


@query("src16_prefix_listing", f"SELECT page_id, url, count(*) OVER () > {LISTED} AS refused FROM pages WHERE starts_with(url, 'http')")
def src16(spark: SparkSession, sf: str) -> DataFrame:
    """The whole listing of a prefix, which is pushed to the scan; a listing of more than 100,000 names is refused (flagged)."""
    named = table(spark, sf, "pages").filter(F.col("url").startswith("http")).select("page_id", "url")
    over = named.limit(LISTED + 1).agg((F.count(F.lit(1)) > LISTED).alias("refused"))
    return named.crossJoin(F.broadcast(over))  # one row


@query("src17_point_query", "SELECT conv_id AS id, turn AS version_id FROM conversations WHERE conv_id = 5 AND turn = 0 LIMIT 1")
def src17(spark: SparkSession, sf: str) -> DataFrame:
    """The stored query with named parameters."""
    return spark.sql(
        "SELECT conv_id AS id, turn AS version_id FROM {bundle} WHERE conv_id = :bundle_id AND turn = :version_id LIMIT 1",
        args={"bundle_id": 5, "version_id": 0}, bundle=table(spark, sf, "conversations"),
    )


@query("src18_content_store", "SELECT sha256(coalesce(text, '')) AS content_sha256, min(doc_id) AS first_doc_id, count(*) AS n_copies FROM documents GROUP BY 1")
def src18(spark: SparkSession, sf: str) -> DataFrame:
    """Content-addressed store: one entry a digest; the digest is made before the shuffle, which carries no text."""
    d = table(spark, sf, "documents").select("doc_id", hashing.sha256_text(F.coalesce("text", F.lit(""))).alias("content_sha256"))
    return d.groupBy("content_sha256").agg(F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("n_copies"))


def stored(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """content_sha256, source, result: the reads of the store for asked digests; result is the reading of the
    source (its number of sections), and both are null where nothing is stored under the digest."""
    kept = docs.select(hashing.sha256_text(F.coalesce("text", F.lit(""))).alias("content_sha256"), F.coalesce("text", F.lit("")).alias("source"))
    asked = kept.join(joins.small(digests), "content_sha256", "left_semi").dropDuplicates(["content_sha256"])
    return digests.join(asked, "content_sha256", "left").select("content_sha256", "source", F.when(F.col("source").isNotNull(), F.size(F.split("source", "\n"))).alias("result"))


@query(
    "src18_store_reads",
    "WITH a AS (SELECT DISTINCT CASE WHEN item_id % 2 = 0 THEN sha256(coalesce((SELECT text FROM documents d WHERE d.doc_id = item_id), '')) ELSE sha256('absent' || item_id) END AS content_sha256 FROM benchmark), s AS (SELECT sha256(coalesce(text, '')) AS content_sha256, any_value(coalesce(text, '')) AS source FROM documents GROUP BY 1) SELECT content_sha256, sha256(source) AS source_sha256, CAST(len(string_split(source, chr(10))) AS INT) AS result FROM a LEFT JOIN s USING (content_sha256)",
)
def src18b(spark: SparkSession, sf: str) -> DataFrame:
    """Sources and results read back by digest; every second digest is not stored."""
    d = table(spark, sf, "documents")
    known = table(spark, sf, "benchmark").select("item_id").join(d.select(F.col("doc_id").alias("item_id"), "text"), "item_id", "left")
    digest = F.when(F.col("item_id") % 2 == 0, F.sha2(F.coalesce("text", F.lit("")), 256)).otherwise(F.sha2(F.concat(F.lit("absent"), F.col("item_id").cast("string")), 256))
    return stored(d, known.select(digest.alias("content_sha256")).distinct()).select("content_sha256", F.sha2("source", 256).alias("source_sha256"), "result")


@query("f1_flatten_sections", f"WITH {SECTIONS_SQL} SELECT doc_id, pos, 'section[' || pos || ']' AS path, sha256(body) AS body_sha256 FROM sections")
def f1(spark: SparkSession, sf: str) -> DataFrame:
    """All sections in document order, each with its path; a generator, no shuffle."""
    return sections(spark, sf).select("doc_id", "pos", "path", hashing.sha256_text(F.col("body")).alias("body_sha256"))


@query("f4_document_gate", "SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND n_chars BETWEEN 100 AND 2000 AND source <> 'src0'")
def f4(spark: SparkSession, sf: str) -> DataFrame:
    """Type and size gate; every condition is pushed into the scan."""
    return table(spark, sf, "documents").filter((F.col("lang") == "en") & F.col("n_chars").between(100, 2000) & (F.col("source") != "src0")).select("doc_id", "lang", "source")


@query("f5_language_gate", "SELECT doc_id, regexp_matches(lang, '^en(-[A-Z]{2})?$') AS accepted FROM documents")
def f5(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.col("lang").rlike("^en(-[A-Z]{2})?$").alias("accepted"))


@query(
    "f6_entitlement",
    "SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'ok' ELSE 'document-not-found' END AS caller_outcome, CASE WHEN l.doc_id IS NOT NULL THEN 'ok' ELSE 'not-entitled' END AS audit_outcome FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) l USING (doc_id)",
)
def f6(spark: SparkSession, sf: str) -> DataFrame:
    """The caller cannot tell a refused document from a missing one; the audit can. No text is read."""
    entitled = table(spark, sf, "labels").filter("quality = 1").select("doc_id", F.lit(True).alias("may")).distinct()
    d = table(spark, sf, "documents").select("doc_id").join(entitled, "doc_id", "left")
    return d.select("doc_id", F.when(F.col("may"), "ok").otherwise("document-not-found").alias("caller_outcome"), F.when(F.col("may"), "ok").otherwise("not-entitled").alias("audit_outcome"))


@query(
    "f15_free_text_limits",
    f"WITH {SECTIONS_SQL} SELECT doc_id, count(*) AS n_strings, CAST(sum(length(body)) AS BIGINT) AS n_code_points, count(*) FILTER (length(body) > 300) AS n_long, count(*) FILTER (contains(body, '<')) AS n_markup, count(*) > 3000 OR sum(length(body)) > 40000 AS refused FROM sections GROUP BY doc_id",
)
def f15(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf strings against the limits of unverified text."""
    n = F.length("body")
    total, count = F.sum(n), F.count(F.lit(1))
    return sections(spark, sf).groupBy("doc_id").agg(
        count.alias("n_strings"), total.cast("long").alias("n_code_points"), F.count_if(n > 300).alias("n_long"), F.count_if(F.contains("body", F.lit("<"))).alias("n_markup"), ((count > 3000) | (total > 40000)).alias("refused")
    )


@query("f20_forbidden_offset", "SELECT doc_id, CASE WHEN regexp_matches(text, '[^ -~\n]') THEN length(regexp_extract(text, '^[ -~\n]*', 0)) END AS at FROM documents")
def f20(spark: SparkSession, sf: str) -> DataFrame:
    """Code-point offset of the first character outside a class."""
    at = F.regexp_instr("text", F.lit("[^ -~\\n]"))
    return table(spark, sf, "documents").select("doc_id", F.when(at > 0, at - 1).cast("long").alias("at"))


@query(
    "f24_error_codes",
    "SELECT event_id, CASE WHEN user_id IS NULL THEN 'invalid-request' WHEN event_type = 'error' THEN 'upstream-unavailable' WHEN value IS NULL THEN 'document-not-found' ELSE 'ok' END AS outcome FROM events",
)
def f24(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id").isNull(), "invalid-request").when(F.col("event_type") == "error", "upstream-unavailable").when(F.col("value").isNull(), "document-not-found").otherwise("ok").alias("outcome")
    )


@query(
    "f26_first_refusal",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' WHEN o_totalprice > 200000 THEN 'too-large' WHEN o_orderpriority LIKE '5%' THEN 'unranked' END AS refusal FROM orders",
)
def f26(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered refusal codes: the first that applies."""
    return table(spark, sf, "orders").select(
        "o_orderkey", F.coalesce(F.when(F.col("o_orderstatus") == "F", "closed"), F.when(F.col("o_totalprice") > 200000, "too-large"), F.when(F.col("o_orderpriority").startswith("5"), "unranked")).alias("refusal")
    )


@query("f11_any_error", "SELECT user_id, bool_or(event_type = 'error') AS has_errors, count(*) FILTER (event_type = 'error') AS n_errors FROM events GROUP BY user_id")
def f11(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_type") == "error"
    return table(spark, sf, "events").groupBy("user_id").agg(F.bool_or(e).alias("has_errors"), F.count_if(e).alias("n_errors"))


# query tools


@query(
    "t1_find_product",
    "WITH h AS (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) r FROM part WHERE p_partkey IN (SELECT DISTINCT l_partkey FROM lineitem)), m AS (SELECT * FROM h WHERE r <= 200 AND contains(lower(p_name), 'a')), s AS (SELECT l_partkey, min(l_suppkey) AS holder FROM lineitem GROUP BY 1) SELECT m.p_partkey AS product_id, m.p_name AS name, s.holder, (SELECT count(*) FROM m) > 50 OR (SELECT max(r) FROM h) > 200 AS truncated FROM m JOIN s ON s.l_partkey = m.p_partkey ORDER BY m.p_partkey LIMIT 50",
)
def t1(spark: SparkSession, sf: str) -> DataFrame:
    """Products among the entitled whose name holds the query, in entitlement order: a horizon of 200,
    at most 50 answers, and whether anything was left out. The horizon is a top-k, so no global sort."""
    entitled = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s")).groupBy("p_partkey").agg(F.min("s").alias("holder"))
    seen = table(spark, sf, "part").select("p_partkey", "p_name").join(entitled, "p_partkey").orderBy("p_partkey").limit(201)
    flagged = seen.withColumn("r", F.row_number().over(_all_by("p_partkey")))
    matches = flagged.withColumn("over", F.max("r").over(_all()) > 200).filter((F.col("r") <= 200) & F.contains(F.lower("p_name"), F.lit("a")))
    counted = matches.withColumn("truncated", F.col("over") | (F.count(F.lit(1)).over(_all()) > 50))
    return counted.orderBy("p_partkey").limit(checked_limit(50)).select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), "holder", "truncated")


def _all_by(c):
    return Window.orderBy(c)


def _all():
    return Window.partitionBy()


@query(
    "t3_get_provenance",
    f"WITH {LATEST_SQL}, h AS (SELECT conv_id, count(*) AS n_versions, min(turn) AS first_version FROM conversations GROUP BY 1) SELECT l.bundle_id, l.version_id, l.role AS agent, sha256(l.body) AS content_sha256, h.n_versions, h.first_version FROM latest l JOIN h ON h.conv_id = l.bundle_id",
)
def t3(spark: SparkSession, sf: str) -> DataFrame:
    """Current version of each document with its history: one aggregation, no self join."""
    v = versions(spark, sf)
    newest = F.max(F.struct("version_id", F.struct("role", "body").alias("at"))).alias("n")
    g = v.groupBy("bundle_id").agg(newest, F.count(F.lit(1)).alias("n_versions"), F.min("version_id").alias("first_version"))
    return g.select("bundle_id", F.col("n.version_id").alias("version_id"), F.col("n.at.role").alias("agent"), hashing.sha256_text(F.col("n.at.body")).alias("content_sha256"), "n_versions", "first_version")


@query("j16_version_standing", f"WITH {LATEST_SQL} SELECT v.bundle_id, v.version_id, CASE WHEN v.version_id = l.version_id THEN 'current' ELSE 'superseded' END AS standing FROM v JOIN latest l USING (bundle_id)")
def j16(spark: SparkSession, sf: str) -> DataFrame:
    v = versions(spark, sf)
    newest = v.groupBy("bundle_id").agg(F.max("version_id").alias("newest"))
    return v.join(newest, "bundle_id").select("bundle_id", "version_id", F.when(F.col("version_id") == F.col("newest"), "current").otherwise("superseded").alias("standing"))


@query("j25_entitled_in_order", "SELECT d.doc_id, l.quality, row_number() OVER (ORDER BY l.quality DESC, d.doc_id) AS place FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 0 ORDER BY place LIMIT 200")
def j25(spark: SparkSession, sf: str) -> DataFrame:
    """The first 200 entitled documents in entitlement order."""
    e = table(spark, sf, "labels").filter("toxic = 0").select("doc_id", "quality")
    first = table(spark, sf, "documents").select("doc_id").join(e, "doc_id").orderBy(F.desc("quality"), "doc_id").limit(200)
    return first.withColumn("place", F.row_number().over(Window.orderBy(F.desc("quality"), "doc_id")).cast("long"))


@query(
    "j14_baseline_review",
    "WITH a AS (SELECT conv_id, role, text FROM conversations WHERE turn = 0), b AS (SELECT conv_id, role, text FROM conversations WHERE turn = 2) SELECT coalesce(a.conv_id, b.conv_id) AS bundle_id, CASE WHEN a.conv_id IS NULL THEN 'added' WHEN b.conv_id IS NULL THEN 'removed' WHEN a.text IS NOT DISTINCT FROM b.text THEN 'unchanged' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.conv_id = b.conv_id",
)
def j14(spark: SparkSession, sf: str) -> DataFrame:
    """Approved baseline against the current state."""
    v = versions(spark, sf)
    return joins.difference(v.filter("version_id = 0"), v.filter("version_id = 2"), ["bundle_id"], "body").select("bundle_id", "change")
