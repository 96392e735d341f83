"""Tools around the store: answers checked, approvals decided, documents taken in, records rendered."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing, signatures
from ..operators import graphs
from ..scratch import shared_path
from ..sources import authority
from ..sources.tables import table
from ..streaming import sinks
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql

# answers


def _answers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, verifications) of drafts made of conversations: a block a turn; verifications of some blocks are
    missing, given twice, unsupported, or name a block that is not there."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("answer"), "turn", F.col("text").alias("chunk"))
    k = F.col("answer") * 5 + F.col("turn")
    v = c.select("answer", F.when(k % 13 == 4, F.col("turn") + 1000).otherwise(F.col("turn")).alias("index"), F.when(k % 11 == 7, "unsupported").otherwise("match").alias("result"), k.alias("k")).filter("k % 17 <> 3")
    again = v.filter("k % 19 = 5")
    return c, v.unionByName(again).select("answer", "index", "result")


_ANSWERS_SQL = """b AS (SELECT conv_id AS answer, turn, conv_id * 5 + turn AS k, text AS chunk FROM conversations),
v1 AS (SELECT answer, CASE WHEN k % 13 = 4 THEN turn + 1000 ELSE turn END AS index, CASE WHEN k % 11 = 7 THEN 'unsupported' ELSE 'match' END AS result, k FROM b WHERE k % 17 <> 3),
v AS (SELECT answer, index, result FROM v1 UNION ALL SELECT answer, index, result FROM v1 WHERE k % 19 = 5),
c AS (SELECT coalesce(b.answer, v.answer) AS answer, coalesce(b.turn, v.index) AS index, count(v.index) AS n, max(b.turn) IS NOT NULL AS there, bool_and(v.result = 'match') AS good FROM b FULL JOIN v ON b.answer = v.answer AND b.turn = v.index GROUP BY 1, 2),
s AS (SELECT answer, index, CASE WHEN NOT there THEN 'extra' WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'duplicate' WHEN NOT good THEN 'unsupported' ELSE 'verified' END AS state FROM c)"""


def checked_answers(blocks: DataFrame, verifications: DataFrame) -> DataFrame:
    """answer, index, state: each chunk against the verifications of its index, and those without a chunk."""
    v = verifications.groupBy("answer", "index").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("result") == "match").alias("good"))
    b = blocks.select("answer", F.col("turn").alias("index"), F.lit(True).alias("there"))
    j = b.join(v, ["answer", "index"], "full_outer")
    state = F.when(F.col("there").isNull(), "extra").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "duplicate").when(~F.col("good"), "unsupported").otherwise("verified")
    return j.select("answer", "index", state.alias("state"))


@query("j17_answer_check", f"WITH {_ANSWERS_SQL} SELECT answer, index, state FROM s")
def j17(spark: SparkSession, sf: str) -> DataFrame:
    """Verifications against chunks by index: missing, duplicate, extra, unsupported or verified."""
    return checked_answers(*_answers(spark, sf))


FLAGS = ("extra", "duplicate", "missing", "unsupported")


@query(
    "t9_answer_postcheck",
    f"WITH {_ANSWERS_SQL} SELECT answer, count(*) FILTER (state <> 'extra') AS n_chunks, count(*) FILTER (state = 'verified') AS n_verified, array_to_string(list_filter(['extra', 'duplicate', 'missing', 'unsupported'], lambda f: list_contains(list(state), f)), ',') AS flags, CASE WHEN bool_and(state = 'verified') THEN 'verified' ELSE 'flagged' END AS outcome FROM s GROUP BY 1",
)
def t9(spark: SparkSession, sf: str) -> DataFrame:
    """Answers verified or flagged, with their flags in order of priority."""
    good = F.col("state") == "verified"
    g = j17(spark, sf).groupBy("answer").agg(F.count_if(F.col("state") != "extra").alias("n_chunks"), F.count_if(good).alias("n_verified"), F.collect_set("state").alias("seen"), F.bool_and(good).alias("all"))
    flags = F.array_intersect(F.array(*[F.lit(f) for f in FLAGS]), F.col("seen"))
    return g.select("answer", "n_chunks", "n_verified", F.array_join(flags, ",").alias("flags"), F.when(F.col("all"), "verified").otherwise("flagged").alias("outcome"))


@query(
    "t14_turn_audit",
    f"WITH {_ANSWERS_SQL}, calls AS (SELECT user_id, count(*) AS n_calls, count(DISTINCT event_type) AS n_tools FROM events GROUP BY 1), g AS (SELECT answer, count(*) FILTER (state = 'verified') AS n_verified, count(*) FILTER (state NOT IN ('verified', 'extra')) AS n_flagged FROM s GROUP BY 1) SELECT answer, n_verified, n_flagged, coalesce(n_calls, 0) AS n_calls, coalesce(n_tools, 0) AS n_tools FROM g LEFT JOIN calls ON answer = user_id",
)
def t14(spark: SparkSession, sf: str) -> DataFrame:
    """One audit record a turn: chunks verified and flagged, and the tool calls of the turn (events of the user)."""
    state = F.col("state")
    g = j17(spark, sf).groupBy("answer").agg(F.count_if(state == "verified").alias("n_verified"), F.count_if(~state.isin("verified", "extra")).alias("n_flagged"))
    calls = table(spark, sf, "events").groupBy(F.col("user_id").alias("answer")).agg(F.count(F.lit(1)).alias("n_calls"), F.count_distinct("event_type").alias("n_tools"))
    return g.join(calls, "answer", "left").select("answer", "n_verified", "n_flagged", F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_tools", F.lit(0)).alias("n_tools"))


# approvals

_STATEMENTS_SQL = """st AS (SELECT o_custkey AS document, row_number() OVER w AS sequence, o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)) AS sha, o_orderkey % 41 = 8 AS malformed,
  CASE WHEN o_orderkey % 23 = 5 THEN 'forged' ELSE lag(sha256(CAST(o_orderkey AS VARCHAR))) OVER w END AS previous FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
chk AS (SELECT *, coalesce(previous IS NOT DISTINCT FROM lag(sha) OVER (PARTITION BY document ORDER BY sequence), false) AS linked FROM st),
hd AS (SELECT document, max(sequence) AS head, arg_max(sha, sequence) AS head_sha, bool_or(malformed) AS poisoned, bool_and(linked) AS sound FROM chk GROUP BY 1)"""


def _statements(spark: SparkSession, sf: str) -> DataFrame:
    """document, sequence, sha, previous, malformed: the orders of a customer are the statements of a document."""
    own = Window.partitionBy("document").orderBy("o_orderkey")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("document"), "o_orderkey", F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha"))
    forged = F.col("o_orderkey") % 23 == 5
    return o.select("document", "o_orderkey", F.row_number().over(own).alias("sequence"), "sha", F.when(forged, "forged").otherwise(F.lag("sha").over(own)).alias("previous"), (F.col("o_orderkey") % 41 == 8).alias("malformed"))


def heads(statements: DataFrame) -> DataFrame:
    """document, head, head_sha, poisoned, sound: the head of each chain; one malformed name spoils the document,
    one broken link makes it unsound."""
    before = F.lag("sha").over(Window.partitionBy("document").orderBy("sequence"))
    linked = statements.withColumn("linked", F.col("previous").eqNullSafe(before))
    return linked.groupBy("document").agg(F.max("sequence").alias("head"), F.max_by("sha", "sequence").alias("head_sha"), F.bool_or("malformed").alias("poisoned"), F.bool_and("linked").alias("sound"))


@query(
    "t10_approval_decision",
    f"WITH {_STATEMENTS_SQL}, r AS (SELECT c_custkey AS document, CASE WHEN c_custkey % 4 = 1 THEN 'stale' END AS named, c_acctbal < 0 AS withdrawn FROM customer) SELECT r.document, CASE WHEN withdrawn THEN 'withdrawn' WHEN coalesce(poisoned, false) THEN 'malformed-head' WHEN NOT coalesce(sound, true) THEN 'broken-chain' WHEN head IS NOT NULL AND named IS NOT NULL THEN 'stale-head' ELSE 'approved' END AS decision, CASE WHEN NOT withdrawn AND NOT coalesce(poisoned, false) AND coalesce(sound, true) AND NOT (head IS NOT NULL AND named IS NOT NULL) THEN coalesce(head, 0) + 1 END AS next_sequence FROM r LEFT JOIN hd USING (document)",
)
def t10(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews (customers) against the heads of their documents: the first reason to refuse, or the sequence of
    the statement that follows."""
    h = heads(_statements(spark, sf))
    r = table(spark, sf, "customer").select(F.col("c_custkey").alias("document"), (F.col("c_custkey") % 4 == 1).alias("stale"), (F.col("c_acctbal") < 0).alias("withdrawn"))
    j = r.join(h, "document", "left")
    refusal = F.coalesce(
        F.when(F.col("withdrawn"), "withdrawn"), F.when(F.col("poisoned"), "malformed-head"), F.when(~F.col("sound"), "broken-chain"), F.when(F.col("head").isNotNull() & F.col("stale"), "stale-head")
    )
    return j.select("document", F.coalesce(refusal, F.lit("approved")).alias("decision"), F.when(refusal.isNull(), F.coalesce("head", F.lit(0)) + 1).cast("long").alias("next_sequence"))


@query(
    "t13_approval_events",
    "WITH r AS (SELECT o_orderkey, sha256(o_orderstatus || o_orderkey) AS stored FROM orders WHERE o_orderkey % 5 <> 2), e AS (SELECT o_orderkey, sha256(CASE WHEN o_orderkey % 7 = 3 THEN 'changed' ELSE o_orderstatus || o_orderkey END) AS rebuilt FROM orders), d AS (SELECT o_orderkey, CASE WHEN stored IS NULL THEN 'no-review' WHEN stored <> rebuilt THEN 'review-changed' ELSE 'approved' END AS outcome FROM e LEFT JOIN r USING (o_orderkey)) SELECT outcome, count(*) AS n, count(*) FILTER (outcome = 'approved') AS n_appended FROM d GROUP BY 1",
)
def t13(spark: SparkSession, sf: str) -> DataFrame:
    """Chat events: reviews are stored once, an approval rebuilds its review and appends a head only if the hash is
    the stored one; the same events sent again append nothing."""
    o = table(spark, sf, "orders").select("o_orderkey", F.concat("o_orderstatus", F.col("o_orderkey").cast("string")).alias("review"))
    path, head = shared_path(spark, "reviews"), shared_path(spark, "heads")
    sinks.append_new(o.filter("o_orderkey % 5 <> 2").select("o_orderkey", F.sha2("review", 256).alias("stored")), path, "o_orderkey")
    rebuilt = o.select("o_orderkey", F.sha2(F.when(F.col("o_orderkey") % 7 == 3, "changed").otherwise(F.col("review")), 256).alias("rebuilt"))
    j = rebuilt.join(spark.read.schema("o_orderkey long, stored string").parquet(path), "o_orderkey", "left")
    d = j.select("o_orderkey", F.when(F.col("stored").isNull(), "no-review").when(F.col("stored") != F.col("rebuilt"), "review-changed").otherwise("approved").alias("outcome"))
    approved = d.filter("outcome = 'approved'").select("o_orderkey")
    sinks.append_new(approved, head, "o_orderkey")
    sinks.append_new(approved, head, "o_orderkey")
    appended = spark.read.schema("o_orderkey long").parquet(head).withColumn("hit", F.lit(1))
    return d.join(appended, "o_orderkey", "left").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("n_appended"))


# Fixed values of a test key: two primes. Real keys are given; only their public half is ever needed.
P = 0xF569EAFA15074761C6BF96BE5E15D5E3676D155E97255CCAFC38C8EA3EE6358DCE0A1FE21392CD70FA36E34391F51F53A916AC1E2B88C0EF68DE9BDA6D0BE2D7
Q = 0xF86CCC3B0EACF179CBF01DBFBCC855062D4878D63F37E2595EC2F9E6F78646DD948EF03DBD715241188AAB366900C9558B422C7B8B968B33D54C5A025CB1D0F9
EXPONENT = 65537


@query("h10_signatures", "SELECT n_nationkey, n_nationkey % 3 <> 1 AND n_nationkey % 5 <> 4 AS valid FROM nation")
def h10(spark: SparkSession, sf: str) -> DataFrame:
    """Signed statements verified: some were changed after signing, some signatures were. The fixture is signed
    on the driver (a dimension of 25 rows)."""
    d = pow(EXPONENT, -1, (P - 1) * (Q - 1))
    rows = table(spark, sf, "nation").select("n_nationkey", "n_name").limit(1000).collect()
    signed = []
    for k, name in rows:
        s = signatures.sign(P * Q, d, name.encode(), hashlib.sha256(str(k).encode()).digest())
        signed.append((k, name + "!" if k % 3 == 1 else name, (bytes([s[0] ^ 1]) + s[1:] if k % 5 == 4 else s).hex()))
    given = spark.createDataFrame(signed, "n_nationkey int, message string, signature string")
    return given.select("n_nationkey", signatures.verified_by(P * Q, EXPONENT)(F.col("message"), F.col("signature")).alias("valid"))


# the store and its services


@query("t11_reader_service", "WITH s AS (SELECT sha256(text) AS content_sha256, count(*) AS n_posted, any_value(text) AS text FROM documents WHERE text IS NOT NULL GROUP BY 1) SELECT content_sha256, n_posted, 1 AS n_stored, CAST(len(string_split(text, chr(10))) AS INT) AS n_sections, length(text) AS n_source FROM s")
def t11(spark: SparkSession, sf: str) -> DataFrame:
    """Documents posted to the content store and read back: each content is stored once, with its source; the
    result is made of what was stored. Posting all again stores nothing."""
    d = table(spark, sf, "documents").filter("text IS NOT NULL").select(F.sha2("text", 256).alias("content_sha256"), F.col("text").alias("source"))
    path = shared_path(spark, "store")
    sinks.ingest(d, path, "content_sha256")
    sinks.ingest(d, path, "content_sha256")
    kept = spark.read.schema(d.schema).parquet(path).groupBy("content_sha256").agg(F.count(F.lit(1)).cast("int").alias("n_stored"), F.max(F.size(F.split("source", "\n"))).alias("n_sections"), F.max(F.length("source")).cast("long").alias("n_source"))
    posted = d.groupBy("content_sha256").agg(F.count(F.lit(1)).alias("n_posted"))
    return posted.join(kept, "content_sha256").select("content_sha256", "n_posted", "n_stored", "n_sections", "n_source")


@query("snk7_content_ingest", "SELECT count(*) AS n_received, count(DISTINCT text) AS n_stored, CAST(sum(length(text)) FILTER (r = 1) AS BIGINT) AS n_characters FROM (SELECT text, row_number() OVER (PARTITION BY text) AS r FROM documents WHERE text IS NOT NULL)")
def snk7(spark: SparkSession, sf: str) -> DataFrame:
    """Content goes into the store once, with its bytes; the receipt tells what was new."""
    d = table(spark, sf, "documents").filter("text IS NOT NULL").select(F.sha2("text", 256).alias("content_sha256"), F.col("text").alias("source"))
    path = shared_path(spark, "content")
    received, _ = d.count(), sinks.ingest(d, path, "content_sha256")
    return spark.read.schema(d.schema).parquet(path).agg(F.lit(received).cast("long").alias("n_received"), F.count(F.lit(1)).alias("n_stored"), F.sum(F.length("source")).alias("n_characters"))


def handle(spark: SparkSession, sf: str, request: dict) -> dict:
    """The worker's entry: health, or one run of a document through the gate."""
    if request.get("path") == "/healthz":
        return {"status": "ok"}
    if request.get("path") != "/v1/runs" or not isinstance(request.get("doc_id"), int):
        return {"status": "invalid-request"}
    found = table(spark, sf, "documents").filter(F.col("doc_id") == request["doc_id"]).select("lang", "n_chars").head()
    if found is None:
        return {"status": "not-found"}
    return {"status": "accepted" if found["lang"] == "en" and 100 <= found["n_chars"] <= 5000 else "refused"}


@query(
    "t12_worker",
    "SELECT * FROM (SELECT 0 AS n, 'ok' AS status UNION ALL SELECT 1, 'invalid-request' UNION ALL SELECT 2, 'not-found' UNION ALL SELECT 3 + doc_id, CASE WHEN lang = 'en' AND n_chars BETWEEN 100 AND 5000 THEN 'accepted' ELSE 'refused' END FROM documents WHERE doc_id < 5)",
)
def t12(spark: SparkSession, sf: str) -> DataFrame:
    """The entry asked for its health, wrongly, and for a few runs (point reads)."""
    asked = [{"path": "/healthz"}, {"path": "/v1/runs"}, {"path": "/v1/runs", "doc_id": -7}, *({"path": "/v1/runs", "doc_id": i} for i in range(5))]
    return spark.createDataFrame([(n, handle(spark, sf, r)["status"]) for n, r in enumerate(asked)], "n long, status string")


@query("src7_authority_fetch", "SELECT n_nationkey, CASE WHEN n_nationkey % 7 = 6 THEN 'not-indexed' WHEN n_nationkey % 5 = 2 THEN 'pin-mismatch' ELSE 'trusted' END AS outcome FROM nation")
def src7(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of an authority, read as files, against its index: only bytes that hash to their pin are trusted."""
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    path = shared_path(spark, "authority")
    n.select("n_nationkey", F.col("n_name").alias("value")).write.partitionBy("n_nationkey").text(path)
    pin = F.sha2(F.concat(F.when(k % 5 == 2, F.lit("other ")).otherwise(F.lit("")), "n_name", F.lit("\n")), 256)
    index = n.filter(k % 7 != 6).select(F.col("n_nationkey").cast("string").alias("name"), pin.alias("pin"))
    found = authority.fetch(spark, path, index, "n_nationkey=([0-9]+)")
    return found.select(F.col("name").cast("int").alias("n_nationkey"), "outcome")


@query("src8_source_resource", "SELECT conv_id AS id, turn AS version_id, role AS resource_type, sha256(coalesce(text, '')) AS sha FROM conversations WHERE role = 'user' AND conv_id % 3 = 1")
def src8(spark: SparkSession, sf: str) -> DataFrame:
    """Resources of one type and set of ids, read from the source store; both conditions reach the scan."""
    c = table(spark, sf, "conversations").filter("role = 'user' AND conv_id % 3 = 1")
    return c.select(F.col("conv_id").alias("id"), F.col("turn").alias("version_id"), F.col("role").alias("resource_type"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query(
    "snk11_review_page",
    "WITH r AS (SELECT conv_id, turn, role, replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS t FROM conversations) SELECT conv_id, sha256('<!doctype html><title>Review ' || conv_id || '</title><ol>' || string_agg('<li value=\"' || turn || '\"><b>' || role || '</b> ' || t || '</li>', '' ORDER BY turn, role) || '</ol>') AS page_sha256 FROM r GROUP BY 1",
)
def snk11(spark: SparkSession, sf: str) -> DataFrame:
    """Review pages: the same bytes for the same record, all text escaped."""
    item = F.concat(F.lit('<li value="'), F.col("turn").cast("string"), F.lit('"><b>'), "role", F.lit("</b> "), _escaped(F.coalesce("text", F.lit(""))), F.lit("</li>"))
    r = table(spark, sf, "conversations").select("conv_id", F.struct("turn", "role", item.alias("item")).alias("r")).groupBy("conv_id").agg(F.array_sort(F.collect_list("r")).alias("r"))
    page = F.concat(F.lit("<!doctype html><title>Review "), F.col("conv_id").cast("string"), F.lit("</title><ol>"), F.array_join(F.transform("r", lambda x: x["item"]), ""), F.lit("</ol>"))
    return r.select("conv_id", F.sha2(page, 256).alias("page_sha256"))


@query(
    "snk12_code_system",
    "SELECT p_brand, sha256('{\"resourceType\":\"CodeSystem\",\"url\":\"urn:codes:' || p_brand || '\",\"count\":' || count(*) || ',\"concept\":[' || string_agg('{\"code\":\"' || p_partkey || '\",\"display\":\"' || p_name || '\"}', ',' ORDER BY p_partkey) || ']}') AS code_system, sha256('{\"resourceType\":\"ConceptMap\",\"url\":\"urn:map:' || p_brand || '\",\"element\":[' || string_agg('{\"source\":\"' || p_partkey || '\",\"target\":\"' || p_type || '\"}', ',' ORDER BY p_partkey) || ']}') AS concept_map FROM part GROUP BY 1",
)
def snk12(spark: SparkSession, sf: str) -> DataFrame:
    """Code systems and concept maps as JSON, generated from a mapping table (one a brand)."""
    g = table(spark, sf, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name", "p_type"))).alias("r"))
    code = F.transform("r", lambda x: F.struct(x["p_partkey"].cast("string").alias("code"), x["p_name"].alias("display")))
    element = F.transform("r", lambda x: F.struct(x["p_partkey"].cast("string").alias("source"), x["p_type"].alias("target")))
    system = F.to_json(F.struct(F.lit("CodeSystem").alias("resourceType"), F.concat(F.lit("urn:codes:"), "p_brand").alias("url"), F.size("r").alias("count"), code.alias("concept")))
    mapped = F.to_json(F.struct(F.lit("ConceptMap").alias("resourceType"), F.concat(F.lit("urn:map:"), "p_brand").alias("url"), element.alias("element")))
    return g.select("p_brand", F.sha2(system, 256).alias("code_system"), F.sha2(mapped, 256).alias("concept_map"))


@query("h8_published_hash", "SELECT event_id, sha256('{\"type\":\"' || event_type || '\",\"user\":' || user_id || '}') AS published FROM events")
def h8(spark: SparkSession, sf: str) -> DataFrame:
    """Canonical hash of a record without its volatile fields (version and time)."""
    e = table(spark, sf, "events")
    record = F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"), F.struct(F.col("event_id").alias("versionId"), F.col("ts").cast("string").alias("lastUpdated")).alias("meta")))
    return e.select("event_id", record.alias("record")).select("event_id", hashing.canonical_without(F.col("record"), "meta").alias("c")).select("event_id", F.sha2("c", 256).alias("published"))


_DEPENDENCIES_SQL = "n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 100 = 7 THEN c_custkey + 1 WHEN c_custkey % 100 = 8 THEN c_custkey - 1 WHEN c_custkey > 1 THEN c_custkey // 3 END AS needs FROM customer)"


@query(
    "l4_dependency_order",
    f"WITH RECURSIVE {_DEPENDENCIES_SQL}, d AS (SELECT id, 0 AS depth FROM n WHERE needs IS NULL OR needs NOT IN (SELECT id FROM n) UNION ALL SELECT n.id, d.depth + 1 FROM n JOIN d ON n.needs = d.id) SELECT n.id, d.depth, d.id IS NULL AS refused FROM n LEFT JOIN d ON d.id = n.id",
)
def l4(spark: SparkSession, sf: str) -> DataFrame:
    """Depth of resources below those they need; resources on a cycle, or behind one, are refused, not lost."""
    k = F.col("c_custkey")
    needs = F.when(k % 100 == 7, k + 1).when(k % 100 == 8, k - 1).when(k > 1, F.expr("c_custkey DIV 3"))
    c = table(spark, sf, "customer").select(k.alias("id"), needs.alias("needs"))
    return graphs.depths(c.select("id"), c.filter("needs IS NOT NULL"))


@query("st10_retry_ladder", "SELECT event_id, least(CAST(event_id % 8 AS INT), 5) AS retries, CASE WHEN event_id % 8 > 5 THEN 'failed' ELSE 'written' END AS outcome, [0, 2, 7, 22, 52, 112][least(CAST(event_id % 8 AS INT), 5) + 1] AS waited FROM events")
def st10(spark: SparkSession, sf: str) -> DataFrame:
    """Waits of a write that fails so many times: 2, 5, 15, 30, 60 seconds, then it has failed."""
    failures = (F.col("event_id") % 8).cast("int")
    ladder = F.array(*[F.lit(s) for s in sinks.LADDER])
    retries = F.least(failures, F.lit(len(sinks.LADDER)))
    waited = F.aggregate(F.slice(ladder, F.lit(1), retries), F.lit(0), lambda a, x: a + x)
    return table(spark, sf, "events").select("event_id", retries.alias("retries"), F.when(failures > len(sinks.LADDER), "failed").otherwise("written").alias("outcome"), waited.alias("waited"))


@query(
    "u1_evidence_passes",
    "WITH d AS (SELECT doc_id, text, source <> 'src1' AND NOT contains(text, '_') AS accepted FROM documents WHERE text IS NOT NULL), ok AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS w FROM d WHERE accepted), r AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM d WHERE NOT accepted), s AS (SELECT doc_id, count(*) FILTER (ok.w IS NULL) AS unknown FROM r LEFT JOIN ok USING (w) GROUP BY 1) SELECT doc_id, CASE WHEN accepted THEN 'first' WHEN unknown <= 2 THEN 'second' ELSE 'refused' END AS accepted_in FROM d LEFT JOIN s USING (doc_id)",
)
def u1(spark: SparkSession, sf: str) -> DataFrame:
    """Two passes: what the first accepts is evidence (its words); what it refused is accepted in the second if all
    but two of its words are known. Words are counted once a text and joined, no set is broadcast."""
    d = table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", "text", ((F.col("source") != "src1") & ~F.contains("text", F.lit("_"))).alias("ok"))
    spread = lambda which: d.filter(which).select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    known = spread("ok").select("w").distinct().withColumn("known", F.lit(True))
    refused = spread("NOT ok OR ok IS NULL").groupBy("doc_id", "w").agg(F.count(F.lit(1)).alias("n"))
    unknown = refused.join(known, "w", "left").groupBy("doc_id").agg(F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("unknown"))
    return d.select("doc_id", "ok").join(unknown, "doc_id", "left").select("doc_id", F.when(F.col("ok"), "first").when(F.col("unknown") <= 2, "second").otherwise("refused").alias("accepted_in"))
