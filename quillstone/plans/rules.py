"""Rules of names, sources, findings and records over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, templates, text
from ..scratch import shared_path
from ..sources import words
from ..sources.tables import table
from ..streaming import events as st
from .edges_sql import normal
from .gates import f18
from .model import SECTIONS_SQL, sections
from .registry import Registry
from .reports import FORMS, HEADINGS
from .verification import VERIFY_SQL, verified

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


@query(
    "w2_sequence_head",
    "WITH n AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 29 = 3 THEN o_custkey || '/' || o_orderkey ELSE o_custkey || '/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') END AS name FROM orders) SELECT o_custkey, CASE WHEN NOT bool_or(NOT regexp_matches(name, '^[0-9]+/[0-9]{12}$')) THEN max(CAST(split_part(name, '/', 2) AS BIGINT)) END AS head, bool_or(NOT regexp_matches(name, '^[0-9]+/[0-9]{12}$')) AS poisoned, count(*) AS entries FROM n GROUP BY 1",
)
def w2(spark: SparkSession, sf: str) -> DataFrame:
    """The highest sequence of each key, read from object names; one malformed name and the key has no head."""
    k = F.col("o_custkey").cast("string")
    name = F.when(F.col("o_orderkey") % 29 == 3, F.concat(k, F.lit("/"), F.col("o_orderkey").cast("string"))).otherwise(hashing.head_name(k, F.col("o_orderkey")))
    o = table(spark, sf, "orders").select("o_custkey", name.alias("name"))
    good = F.col("name").rlike("^[0-9]+/[0-9]{12}$")
    g = o.groupBy("o_custkey").agg(F.max(F.when(good, F.split_part("name", F.lit("/"), F.lit(2)).cast("long"))).alias("head"), F.bool_or(~good).alias("poisoned"), F.count(F.lit(1)).alias("entries"))
    return g.withColumn("head", F.when(~F.col("poisoned"), F.col("head")))


@query(
    "j9_heading_match",
    "WITH f AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, '{f}')" for k, f in FORMS) + ") t(template, form)), p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN '4.1' || chr(9) || ' Therapeutic' || chr(160) || 'indications' WHEN 2 THEN 'Posology  and method' WHEN 3 THEN 'Contents of the  pack' ELSE 'contents of the pack' END AS line FROM part) SELECT p_partkey, min(template) AS template FROM p LEFT JOIN f ON trim(regexp_replace(line, '[ \t\\x{A0}]+', ' ', 'g')) = form GROUP BY 1",
)
def j9(spark: SparkSession, sf: str) -> DataFrame:
    """Lines against all forms of the template headings, both collapsed."""
    k = F.col("p_partkey") % 5
    line = F.when(k == 0, F.col("p_name")).when(k == 1, "4.1\t Therapeutic\u00a0indications").when(k == 2, "Posology  and method").when(k == 3, "Contents of the  pack").otherwise("contents of the pack")
    forms = spark.createDataFrame([(n, f) for n, t in HEADINGS.items() for f in templates.forms(t)], "template int, form string")
    p = table(spark, sf, "part").select("p_partkey", F.trim(text.collapse_template(line)).alias("form"))
    return p.join(F.broadcast(forms), "form", "left").groupBy("p_partkey").agg(F.min("template").alias("template"))


@query(
    "j20_page_score",
    "WITH k AS (SELECT l_orderkey AS page, l_linenumber AS code, min(l_returnflag) AS want FROM lineitem WHERE l_linestatus = 'O' OR l_linenumber < 3 GROUP BY 1, 2), g AS (SELECT l_orderkey AS page, l_linenumber AS code, min(CASE WHEN l_partkey % 7 = 2 THEN 'X' ELSE l_returnflag END) AS got FROM lineitem WHERE l_suppkey % 5 <> 1 GROUP BY 1, 2), s AS (SELECT k.page, CASE WHEN got IS NULL THEN 'absent' WHEN got = want THEN 'same' ELSE 'different' END AS state FROM k LEFT JOIN g USING (page, code)) SELECT page, count(*) AS n_keyed, count(*) FILTER (state = 'same') AS n_same, count(*) FILTER (state = 'absent') AS n_absent, round(count(*) FILTER (state = 'same') / count(*), 4) AS score FROM s GROUP BY 1",
)
def j20(spark: SparkSession, sf: str) -> DataFrame:
    """Composed pages (orders) against the answer key by code: same, different or absent, and the share that is same."""
    li = table(spark, sf, "lineitem")
    page, code = F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("code")
    key = li.filter("l_linestatus = 'O' OR l_linenumber < 3").groupBy(page, code).agg(F.min("l_returnflag").alias("want"))
    got = li.filter("l_suppkey % 5 <> 1").groupBy(page, code).agg(F.min(F.when(F.col("l_partkey") % 7 == 2, "X").otherwise(F.col("l_returnflag"))).alias("got"))
    same = F.coalesce(F.col("got") == F.col("want"), F.lit(False))
    n = F.count(F.lit(1))
    return key.join(got, ["page", "code"], "left").groupBy("page").agg(n.alias("n_keyed"), F.count_if(same).alias("n_same"), F.count_if(F.col("got").isNull()).alias("n_absent"), F.round(F.count_if(same) / n, 4).alias("score"))


#: What each finding of the verification is worth.
SEVERITY = {"page-not-found": "fatal", "page-malformed": "fatal", "outside-body": "error", "hash-mismatch": "error", "span-order": "error", "non-contiguous": "error", "word-cut": "warning", "overlap": "error"}
_SEVERITY_SQL = "sev AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in SEVERITY.items()) + ") t(reason, severity))"


@query(
    "j23_findings_by_code",
    f"WITH {VERIFY_SQL}, {_SEVERITY_SQL} SELECT key % 4 AS code, coalesce(severity, 'unrated') AS severity, count(*) AS n_findings, count(DISTINCT doc_id) AS n_documents FROM res LEFT JOIN sev USING (reason) WHERE status <> 'verified' GROUP BY 1, 2",
)
def j23(spark: SparkSession, sf: str) -> DataFrame:
    """Findings of all sections looked up in the table of severities, by section code."""
    rated = spark.createDataFrame(list(SEVERITY.items()), "reason string, severity string")
    found = verified(spark, sf).filter("status <> 'verified'").select("doc_id", (F.col("key") % 4).alias("code"), "reason").join(F.broadcast(rated), "reason", "left")
    return found.groupBy("code", F.coalesce("severity", F.lit("unrated")).alias("severity")).agg(F.count(F.lit(1)).alias("n_findings"), F.count_distinct("doc_id").alias("n_documents"))


@query(
    "j29_invocation_events",
    "WITH i AS (SELECT user_id, CAST(ts AS DATE) AS invocation, bool_or(event_type = 'purchase') AS answered FROM events GROUP BY 1, 2), l AS (SELECT user_id, max(invocation) AS invocation FROM i WHERE answered GROUP BY 1) SELECT e.event_id, e.user_id, e.event_type FROM events e JOIN l ON e.user_id = l.user_id AND CAST(e.ts AS DATE) = l.invocation WHERE e.event_type <> 'purchase'",
)
def j29(spark: SparkSession, sf: str) -> DataFrame:
    """Tool events of the newest answered invocation of each user only (an invocation is a day, a purchase its answer)."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("invocation"))
    last = e.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("invocation").alias("invocation"))
    return e.filter("event_type <> 'purchase'").join(last, ["user_id", "invocation"], "left_semi").select("event_id", "user_id", "event_type")


@query(
    "f16_marker_gate",
    f"WITH {SECTIONS_SQL} SELECT doc_id, count(*) FILTER (NOT contains(body, 'e')) AS n_unmarked, doc_id % 4 = 0 AS synthetic, CASE WHEN doc_id % 4 = 0 AND count(*) FILTER (NOT contains(body, 'e')) > 0 THEN 'marker-missing' WHEN doc_id % 4 <> 0 AND bool_or(contains(body, 'License')) THEN 'marker-not-allowed' END AS issue FROM sections GROUP BY 1",
)
def f16(spark: SparkSession, sf: str) -> DataFrame:
    """Synthetic documents carry the marker in every section, others carry none (a letter and a word stand for it)."""
    synthetic = F.col("doc_id") % 4 == 0
    bare = F.count_if(~F.contains("body", F.lit("e")))
    marked = F.bool_or(F.contains("body", F.lit("License")))
    g = sections(spark, sf).groupBy("doc_id").agg(bare.alias("n_unmarked"), marked.alias("marked"))
    issue = F.when(synthetic & (F.col("n_unmarked") > 0), "marker-missing").when(~synthetic & F.col("marked"), "marker-not-allowed")
    return g.select("doc_id", "n_unmarked", synthetic.alias("synthetic"), issue.alias("issue"))


@query(
    "f19_source_allow_list",
    "SELECT doc_id, CASE WHEN source IS NULL OR source NOT IN ('src1', 'src2', 'src3', 'src4') THEN 'source-not-allowed' WHEN source = 'src4' AND doc_id % 2 = 0 THEN 'leaflet-not-persisted' WHEN doc_id % 9 = 1 THEN 'reserved-identifier' ELSE 'persisted' END AS outcome FROM documents",
)
def f19(spark: SparkSession, sf: str) -> DataFrame:
    """Sources that a run may come from, leaflets that are checked but not kept, identifiers of reserved namespaces."""
    d = F.col("doc_id")
    identifier = F.when(d % 9 == 1, F.concat(F.lit("urn:reserved:"), d)).otherwise(F.concat(F.lit("urn:own:"), d))
    allowed = F.coalesce(F.col("source").isin("src1", "src2", "src3", "src4"), F.lit(False))
    outcome = F.when(~allowed, "source-not-allowed").when((F.col("source") == "src4") & (d % 2 == 0), "leaflet-not-persisted").when(identifier.startswith("urn:reserved:"), "reserved-identifier").otherwise("persisted")
    return table(spark, sf, "documents").select("doc_id", outcome.alias("outcome"))


@query("f25_audited_services", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'purchase')")
def f25(spark: SparkSession, sf: str) -> DataFrame:
    """The log sink: a stream that keeps the entries of audited services."""
    return st.collect_stream(st.read_events(spark, sf).filter("event_type IN ('error', 'purchase')").select("event_id", "event_type"), "append", "audited")


@query("a18_duration_rollup", "SELECT event_type AS tool, count(*) AS n_calls, round(sum(value), 4) AS total_ms, max(value) AS longest_ms FROM events GROUP BY 1")
def a18(spark: SparkSession, sf: str) -> DataFrame:
    """Calls, time and longest call of each tool, kept by a stream as it runs."""
    g = st.read_events(spark, sf).groupBy(F.col("event_type").alias("tool")).agg(F.count(F.lit(1)).alias("n_calls"), F.round(F.sum("value"), 4).alias("total_ms"), F.max("value").alias("longest_ms"))
    return st.collect_stream(g, "complete", "durations")


@query(
    "a11_word_counts",
    f"SELECT doc_id, CASE WHEN {normal('text')} = '' THEN 0 ELSE len(string_split({normal('text')}, ' ')) END AS n_words, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+')) AS n_segments FROM documents WHERE {normal('text')} IS NOT NULL",
)
def a11(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the normalised text by spaces, and runs of letters and digits (in place of a word segmenter)."""
    d = table(spark, sf, "documents").select("doc_id", "text", text.normalize(F.col("text")).alias("n")).filter("n IS NOT NULL")
    return d.select("doc_id", F.when(F.col("n") == "", 0).otherwise(F.size(F.split("n", " "))).cast("long").alias("n_words"), F.regexp_count("text", F.lit("[\\p{L}\\p{N}\\p{M}_]+")).cast("long").alias("n_segments"))


_CAUSES_SQL = "c AS (SELECT doc_id, len(list_filter([regexp_matches(text, '[0-9]{4}'), contains(text, '<'), contains(text, '|'), length(text) < 400, length(text) > 8000, contains(text, '!!')], lambda x: x)) AS n FROM documents WHERE text IS NOT NULL)"


@query("a20_causes_per_file", f"WITH {_CAUSES_SQL} SELECT n AS n_causes, count(*) AS n_files, (SELECT median(n) FROM c WHERE n > 0) AS median_of_refused FROM c WHERE n > 0 GROUP BY 1")
def a20(spark: SparkSession, sf: str) -> DataFrame:
    """Refused files by how many causes hold them back, and the median of that number."""
    t = F.col("text")
    found = [t.rlike("[0-9]{4}"), F.contains(t, F.lit("<")), F.contains(t, F.lit("|")), F.length(t) < 400, F.length(t) > 8000, F.contains(t, F.lit("!!"))]
    n = sum((c.cast("int") for c in found[1:]), found[0].cast("int"))
    per = table(spark, sf, "documents").filter("text IS NOT NULL").select(n.cast("long").alias("n_causes")).filter("n_causes > 0").groupBy("n_causes").agg(F.count(F.lit(1)).alias("n_files"))
    # The histogram has a few rows; the median is read from it.
    weighted = per.agg(F.expr("percentile(n_causes, 0.5, n_files)").alias("median_of_refused"))
    return per.crossJoin(F.broadcast(weighted))  # one row


@query(
    "p19_tool_version",
    "SELECT p_partkey, CASE WHEN contains(p_brand, '#') THEN split_part(p_brand, '#', 1) ELSE p_brand END AS name, nullif(split_part(p_brand, '#', 2), '') AS version, list_contains(string_split(p_type, ' '), 'STEEL') OR list_contains(string_split(p_type, ' '), 'TIN') AS has_verifier FROM part",
)
def p19(spark: SparkSession, sf: str) -> DataFrame:
    """Name and version of a tool, and whether a participant has one of the types asked for."""
    parts = F.split("p_type", " ")
    return table(spark, sf, "part").select(
        "p_partkey", F.split_part("p_brand", F.lit("#"), F.lit(1)).alias("name"), F.nullif(F.split_part("p_brand", F.lit("#"), F.lit(2)), F.lit("")).alias("version"),
        F.exists(parts, lambda x: x.isin("STEEL", "TIN")).alias("has_verifier"),
    )


@query(
    "p23_named_once",
    f"WITH {SECTIONS_SQL}, h AS (SELECT doc_id, lower(regexp_extract(body, '^\\W*(\\w+)', 1)) AS name FROM sections WHERE pos % 4 = 0 AND regexp_matches(body, '^\\W*\\w')) SELECT doc_id, count(*) AS n_headings, count(DISTINCT name) = 1 AS once, CASE WHEN count(DISTINCT name) = 1 THEN min(name) END AS name FROM h GROUP BY 1",
)
def p23(spark: SparkSession, sf: str) -> DataFrame:
    """The name that all first-section headings (every fourth line) give, if they give one."""
    h = sections(spark, sf).filter("pos % 4 = 0").filter(F.col("body").rlike("^\\W*\\w")).select("doc_id", F.lower(F.regexp_extract("body", "^\\W*(\\w+)", 1)).alias("name"))
    once = F.min("name") == F.max("name")
    return h.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_headings"), once.alias("once"), F.when(once, F.min("name")).alias("name"))


@query(
    "p24_heading_tail",
    "WITH l AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'This leaflet was last revised in ' || strftime(o_orderdate, '%m/%Y') WHEN 1 THEN 'This leaflet was last revised in {MM/YYYY}' WHEN 2 THEN 'This leaflet was last revised in' ELSE 'Revised ' || strftime(o_orderdate, '%m/%Y') END AS line FROM orders) SELECT o_orderkey, regexp_matches(line, '^This leaflet was last revised in( [0-9]{2}/[0-9]{4}| \\{MM/YYYY\\})?$') AS recognised FROM l",
)
def p24(spark: SparkSession, sf: str) -> DataFrame:
    """A heading recognised by its start and a date, a fill-in or nothing behind it."""
    k, date = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "MM/yyyy")
    start = "This leaflet was last revised in"
    line = F.when(k == 0, F.concat(F.lit(start + " "), date)).when(k == 1, start + " {MM/YYYY}").when(k == 2, start).otherwise(F.concat(F.lit("Revised "), date))
    known = line.startswith(start) & F.substring(line, len(start) + 1, 100).rlike("^( [0-9]{2}/[0-9]{4}| \\{MM/YYYY\\})?$")
    return table(spark, sf, "orders").select("o_orderkey", known.alias("recognised"))


@query(
    "p28_provenance_record",
    "SELECT o_orderkey, '{\"resourceType\":\"Provenance\",\"target\":[{\"reference\":\"Bundle/' || o_orderkey || '\"}],\"agent\":[{\"type\":\"author\",\"who\":\"Customer/' || o_custkey || '\"}' || CASE WHEN o_orderstatus = 'F' THEN ',{\"type\":\"verifier\",\"who\":\"tool/1\"}' ELSE '' END || '],\"entity\":[{\"role\":\"source\",\"sha256\":\"' || sha256(CAST(o_orderkey AS VARCHAR)) || '\"}]}' AS record FROM orders",
)
def p28(spark: SparkSession, sf: str) -> DataFrame:
    """Provenance resources made of submissions (orders): target, agents (a verifier only where one acted), sources."""
    agent = lambda kind, who: F.struct(F.lit(kind).alias("type"), who.alias("who"))
    agents = F.array_compact(F.array(agent("author", F.concat(F.lit("Customer/"), "o_custkey")), F.when(F.col("o_orderstatus") == "F", agent("verifier", F.lit("tool/1")))))
    target = F.array(F.struct(F.concat(F.lit("Bundle/"), "o_orderkey").alias("reference")))
    entity = F.array(F.struct(F.lit("source").alias("role"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256")))
    return table(spark, sf, "orders").select("o_orderkey", F.to_json(F.struct(F.lit("Provenance").alias("resourceType"), target.alias("target"), agents.alias("agent"), entity.alias("entity"))).alias("record"))


@query(
    "q6_name_search",
    "WITH q AS (SELECT * FROM (VALUES (1, 'RE'), (2, ' en '), (3, '17'), (4, 'zzz')) t(q, asked)), p AS (SELECT p_partkey, lower(trim(regexp_replace(p_name, '[ \t\r\n]+', ' ', 'g'))) AS name, CAST(p_partkey AS VARCHAR) AS identifier FROM part) SELECT q, p_partkey FROM q JOIN p ON contains(name, lower(trim(asked))) OR identifier = trim(asked)",
)
def q6(spark: SparkSession, sf: str) -> DataFrame:
    """Products whose normalised name holds what is asked for, or whose identifier is it. Queries are a few constants."""
    asked = [(1, "RE"), (2, " en "), (3, "17"), (4, "zzz")]
    p = table(spark, sf, "part").select("p_partkey", F.lower(text.collapse(F.col("p_name"))).alias("name"), F.col("p_partkey").cast("string").alias("identifier"))
    hit = lambda a: F.contains("name", F.lit(a.strip().lower())) | (F.col("identifier") == a.strip())
    return p.select("p_partkey", F.explode(F.array_compact(F.array(*[F.when(hit(a), F.lit(n)) for n, a in asked]))).alias("q")).select("q", "p_partkey")


@query(
    "snk9_lineage_edges",
    "WITH r AS (SELECT l_orderkey AS run, 'source/' || l_suppkey AS src, 'part/' || l_partkey AS mid FROM lineitem) SELECT DISTINCT src, dst FROM (SELECT src, mid AS dst FROM r UNION ALL SELECT mid, 'warehouse/part' FROM r)",
)
def snk9(spark: SparkSession, sf: str) -> DataFrame:
    """Lineage of runs published as edges from source to resource to warehouse table: each edge once, also when all
    runs are published again."""
    r = table(spark, sf, "lineitem").select(F.concat(F.lit("source/"), "l_suppkey").alias("src"), F.concat(F.lit("part/"), "l_partkey").alias("mid"))
    edges = r.select("src", F.col("mid").alias("dst")).unionByName(r.select(F.col("mid").alias("src"), F.lit("warehouse/part").alias("dst"))).distinct()
    path = shared_path(spark, "lineage")
    edges.write.parquet(path)
    again = edges.join(spark.read.schema(edges.schema).parquet(path), ["src", "dst"], "left_anti")
    again.write.mode("append").parquet(path)
    return spark.read.schema(edges.schema).parquet(path)


@query(
    "t2_get_section",
    f"WITH {SECTIONS_SQL}, l AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1), pv AS (SELECT user_id, arg_max(event_id, (ts, -event_id)) AS provenance_id FROM events GROUP BY 1) SELECT s.doc_id, s.pos, 'section[' || s.pos || ']' AS path, sha256(s.body) AS body_sha256, sha256({normal('s.body')}) AS normal_sha256, provenance_id FROM sections s JOIN l USING (doc_id) LEFT JOIN pv ON pv.user_id = s.doc_id",
)
def t2(spark: SparkSession, sf: str) -> DataFrame:
    """Every section of each entitled document with its path, the hashes of its stored and its normalised text, and
    the id of the document\'s newest provenance (of equal times the smallest id)."""
    entitled = table(spark, sf, "labels").filter("quality = 1").select("doc_id").distinct()
    newest = F.max_by("event_id", F.struct("ts", -F.col("event_id")))
    provenance = table(spark, sf, "events").groupBy(F.col("user_id").alias("doc_id")).agg(newest.alias("provenance_id"))
    s = sections(spark, sf).join(entitled, "doc_id", "left_semi").join(provenance, "doc_id", "left")
    return s.select("doc_id", "pos", "path", F.sha2("body", 256).alias("body_sha256"), F.sha2(text.normalize(F.col("body")), 256).alias("normal_sha256"), "provenance_id")


@query("t5_run_pipeline", "SELECT d.source, count(*) AS n_runs, count(*) FILTER (accepted) AS n_persisted FROM (" + f18.sql + ") g JOIN documents d USING (doc_id) GROUP BY 1")
def t5(spark: SparkSession, sf: str) -> DataFrame:
    """Every submission through the whole gate; the accepted ones are appended to the ledger, once, and counted there."""
    judged = f18(spark, sf).select("doc_id", "accepted").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    path = shared_path(spark, "run-ledger")
    judged.write.parquet(path)
    ledger = spark.read.schema(judged.schema).parquet(path)
    return ledger.groupBy("source").agg(F.count(F.lit(1)).alias("n_runs"), F.count_if("accepted").alias("n_persisted"))


@query(
    "src11_tracked_changes",
    f"WITH {SECTIONS_SQL} SELECT doc_id, pos, sha256(CASE WHEN pos % 3 = 1 THEN body || ' new' ELSE body END) AS accepted_sha256, sha256(CASE WHEN pos % 3 = 1 THEN body || ' old' ELSE body END) AS rejected_sha256 FROM sections WHERE NOT contains(body, '++') AND NOT contains(body, '--')",
)
def src11(spark: SparkSession, sf: str) -> DataFrame:
    """Word files with tracked changes, in both views: every third paragraph has a word replaced."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 3 == 1, F.concat(x, F.lit(" {--old--}{++new++}"))).otherwise(x))
    d = table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", words.as_word_file(F.array_join(lines, "\n")).alias("content"))
    p = d.select("doc_id", F.explode(words.paragraphs(F.col("content"))).alias("p"))
    plain = ~F.contains(F.regexp_replace("p.accepted", " new$", ""), F.lit("++")) & ~F.contains("p.accepted", F.lit("--"))
    return p.filter(plain).select("doc_id", "p.pos", F.sha2("p.accepted", 256).alias("accepted_sha256"), F.sha2("p.rejected", 256).alias("rejected_sha256"))


@query("src14_folder_scan", "SELECT doc_id, sha256(text) AS text_sha256 FROM documents WHERE text IS NOT NULL AND doc_id < 40")
def src14(spark: SparkSession, sf: str) -> DataFrame:
    """Word files of a folder read in parallel: path, content and paragraphs, joined to the text that was written
    (a folder of 40 files is the fixture)."""
    d = table(spark, sf, "documents").filter("text IS NOT NULL AND doc_id < 40").select("doc_id", words.as_word_file(F.col("text")).alias("content"))
    path = shared_path(spark, "word-files")
    words.write_folder(d, path, "doc_id")
    found = words.read_folder(spark, path)
    whole = F.array_join(F.transform("paragraphs", lambda p: p["accepted"]), "\n")
    return found.select(F.regexp_extract("path", "([0-9]+)[.]docx$", 1).cast("long").alias("doc_id"), F.sha2(whole, 256).alias("text_sha256"))


@query(
    "src10_word_files",
    f"WITH {SECTIONS_SQL} SELECT doc_id, pos, sha256(body) AS sha, CASE WHEN pos = 0 THEN 'Heading1' END AS style, CASE WHEN pos = 0 THEN length(body) END AS n_bold FROM sections WHERE NOT (pos = 0 AND body = '')",
)
def src10(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as Word files and read back: text, style and marks of every paragraph (the first is a bold heading)."""
    headed = F.concat(F.lit("# "), "text")
    d = table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", words.as_word_file(headed).alias("content"))
    p = d.select("doc_id", F.explode(words.paragraphs(F.col("content"))).alias("p")).filter("NOT (p.pos = 0 AND p.accepted = '')")
    bold = F.aggregate(F.filter("p.marks", lambda m: m["kind"] == "b"), F.lit(0), lambda a, m: a + m["end"] - m["start"])
    return p.select("doc_id", "p.pos", F.sha2("p.accepted", 256).alias("sha"), "p.style", F.when(bold > 0, bold).cast("long").alias("n_bold"))
