"""Window-style scans, spans, joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing, text
from ..operators import joins, windows
from ..operators import spans as span_ops
from ..sources.tables import table
from .model import SECTIONS_SQL, SPANS_SQL, sections, spans
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


@query("w1_latest_row", "SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) r FROM events) WHERE r = 1")
def w1(spark: SparkSession, sf: str) -> DataFrame:
    """Newest row a key, undated last, smallest id of equal times."""
    return windows.latest(table(spark, sf, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts", "event_id")


@query(
    "w3_hash_chain",
    "WITH c AS (SELECT conv_id, turn, sha256(coalesce(text, '')) AS sha FROM conversations), p AS (SELECT *, lag(CASE WHEN conv_id % 9 = 4 AND turn = 1 THEN 'forged' ELSE sha END) OVER d AS prev, lag(sha) OVER d AS want, lag(turn) OVER d AS n FROM c WINDOW d AS (PARTITION BY conv_id ORDER BY turn, sha)) SELECT conv_id, turn, CASE WHEN n IS NULL THEN prev IS NULL ELSE prev = want AND turn = n + 1 END AS linked FROM p",
)
def w3(spark: SparkSession, sf: str) -> DataFrame:
    """Each statement must hash the one before it and follow its sequence; some are forged here."""
    order = Window.partitionBy("conv_id").orderBy("turn", "sha")
    c = table(spark, sf, "conversations").select("conv_id", "turn", hashing.sha256_text(F.coalesce("text", F.lit(""))).alias("sha"))
    signed = c.withColumn("prev", F.lag(F.when((F.col("conv_id") % 9 == 4) & (F.col("turn") == 1), "forged").otherwise(F.col("sha"))).over(order))
    return windows.chain(signed, "conv_id", "turn", "sha", "prev").select("conv_id", "turn", "linked")


@query("w4_gap_scan", f"WITH {SPANS_SQL}, c AS (SELECT *, greatest(s - coalesce(max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS gap FROM spans WHERE e - s > 60) SELECT doc_id, pos, gap FROM c WHERE gap > 1")
def w4(spark: SparkSession, sf: str) -> DataFrame:
    return span_ops.gaps(spans(spark, sf).filter("e - s > 60"), ["doc_id"]).filter("gap > 1").select("doc_id", "pos", "gap")


@query("w5_contiguity", f"WITH {SPANS_SQL}, c AS (SELECT doc_id, pos, s, lag(e) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM spans) SELECT doc_id, bool_and(before IS NULL OR s = before + 1) AS contiguous FROM c GROUP BY 1")
def w5(spark: SparkSession, sf: str) -> DataFrame:
    before = F.lag("e").over(Window.partitionBy("doc_id").orderBy("pos"))
    return spans(spark, sf).withColumn("sound", before.isNull() | (F.col("s") == before + 1)).groupBy("doc_id").agg(F.bool_and("sound").alias("contiguous"))


@query("w6_order_violation", "WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, max(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest_before FROM lineitem) SELECT * FROM r WHERE l_partkey < highest_before")
def w6(spark: SparkSession, sf: str) -> DataFrame:
    return windows.out_of_order(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], ["l_linenumber", "l_partkey"], "l_partkey")


@query("w7_section_assignment", f"WITH {SECTIONS_SQL} SELECT doc_id, pos, last_value(CASE WHEN length(body) < 40 THEN pos END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading_pos FROM sections")
def w7(spark: SparkSession, sf: str) -> DataFrame:
    """Each paragraph belongs to the last heading at or before it (short lines stand for headings)."""
    filled = windows.forward_fill(sections(spark, sf), ["doc_id"], "pos", F.when(F.length("body") < 40, F.col("pos")), "heading_pos")
    return filled.select("doc_id", "pos", "heading_pos")


@query(
    "w8_preceding_heading",
    "WITH e AS (SELECT user_id, event_id, ts, event_type, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heading FROM events) SELECT event_id, heading FROM e WHERE event_type = 'purchase'",
)
def w8(spark: SparkSession, sf: str) -> DataFrame:
    """The heading strictly before each change."""
    over = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", F.last(F.when(F.col("event_type") == "signup", F.col("event_id")), ignorenulls=True).over(over).alias("heading"))
    return e.filter("event_type = 'purchase'").select("event_id", "heading")


@query(
    "w9_sliding_lines",
    f"WITH {SECTIONS_SQL}, j AS (SELECT doc_id, pos, body || coalesce(' ' || lead(body, 1) OVER d, '') || coalesce(' ' || lead(body, 2) OVER d, '') AS joined FROM sections WINDOW d AS (PARTITION BY doc_id ORDER BY pos)) SELECT doc_id, pos, sha256(joined) AS joined_sha256 FROM j",
)
def w9(spark: SparkSession, sf: str) -> DataFrame:
    """Each three lines joined."""
    return windows.sliding(sections(spark, sf), ["doc_id"], "pos", "body", 3).select("doc_id", "pos", F.sha2("joined", 256).alias("joined_sha256"))


@query(
    "w11_block_cap",
    "WITH b AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS n, count(*) OVER (PARTITION BY conv_id) AS total FROM conversations) SELECT conv_id, turn, 'block-' || lpad(CAST(n AS VARCHAR), 2, '0') AS block, greatest(total - 8, 0) AS not_shown FROM b WHERE n <= 8",
)
def w11(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered blocks up to a cap, and how many are not shown."""
    own = Window.partitionBy("conv_id")
    b = table(spark, sf, "conversations").select("conv_id", "turn", F.row_number().over(own.orderBy("turn", "role")).alias("n"), F.count(F.lit(1)).over(own).alias("total"))
    return b.filter("n <= 8").select("conv_id", "turn", F.format_string("block-%02d", "n").alias("block"), F.greatest(F.col("total") - 8, F.lit(0)).alias("not_shown"))


@query("w12_first_appearance", "SELECT body_sha256, doc_id, pos FROM (SELECT sha256(text) AS body_sha256, conv_id AS doc_id, turn AS pos, row_number() OVER (PARTITION BY text ORDER BY conv_id, turn) r FROM conversations WHERE text IS NOT NULL) WHERE r = 1")
def w12(spark: SparkSession, sf: str) -> DataFrame:
    """Repeats go, the first appearance stays: a minimum over a struct, combined before the shuffle."""
    c = table(spark, sf, "conversations").filter("text IS NOT NULL").select(F.sha2("text", 256).alias("body_sha256"), F.struct(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos")).alias("at"))
    return c.groupBy("body_sha256").agg(F.min("at").alias("at")).select("body_sha256", "at.doc_id", "at.pos")


@query(
    "w14_neighbour_flags",
    f"WITH {SECTIONS_SQL} SELECT doc_id, pos, coalesce(contains(lag(body) OVER d, '|'), false) AS after_table, coalesce(contains(lead(body) OVER d, '|'), false) AS before_table FROM sections WINDOW d AS (PARTITION BY doc_id ORDER BY pos)",
)
def w14(spark: SparkSession, sf: str) -> DataFrame:
    over = Window.partitionBy("doc_id").orderBy("pos")
    cell = F.contains("body", F.lit("|"))
    return sections(spark, sf).select("doc_id", "pos", F.coalesce(F.lag(cell).over(over), F.lit(False)).alias("after_table"), F.coalesce(F.lead(cell).over(over), F.lit(False)).alias("before_table"))


@query(
    "w15_close_clusters",
    f"WITH {SECTIONS_SQL}, c AS (SELECT doc_id, pos FROM sections WHERE length(body) > 200), n AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) <= 2 THEN 0 ELSE 1 END AS fresh FROM c), g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS cluster FROM n) SELECT doc_id, min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS n FROM g GROUP BY doc_id, cluster",
)
def w15(spark: SparkSession, sf: str) -> DataFrame:
    """Changed places closer than a distance are one cluster."""
    c = sections(spark, sf).filter(F.length("body") > 200).select("doc_id", "pos")
    apart = F.col("pos") - F.lag("pos").over(Window.partitionBy("doc_id").orderBy("pos")) > 2
    return windows.islands(c, ["doc_id"], "pos", apart).groupBy("doc_id", "island").agg(F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.count(F.lit(1)).alias("n")).drop("island")


@query(
    "w16_rising_runs",
    "WITH p AS (SELECT l_orderkey, l_linenumber, l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS g FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) SELECT l_orderkey, min(l_linenumber) AS first_number, count(*) AS n FROM p GROUP BY l_orderkey, g HAVING count(*) >= 2",
)
def w16(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of two or more numbers that rise by one."""
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    g = d.withColumn("g", F.col("l_linenumber") - F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber")))
    return g.groupBy("l_orderkey", "g").agg(F.min("l_linenumber").alias("first_number"), F.count(F.lit(1)).alias("n")).filter("n >= 2").drop("g")


@query(
    "w18_first_verdict",
    "WITH v AS (SELECT user_id, event_type, arg_min(round(value), (ts, event_id)) AS verdict, count(DISTINCT round(value)) > 1 AS disagreement FROM events GROUP BY 1, 2) SELECT * FROM v",
)
def w18(spark: SparkSession, sf: str) -> DataFrame:
    """The first verdict of each verifier counts; a later different one is a disagreement."""
    e = table(spark, sf, "events").withColumn("verdict", F.round("value"))
    return e.groupBy("user_id", "event_type").agg(F.min_by("verdict", F.struct("ts", "event_id")).alias("verdict"), (F.count_distinct("verdict") > 1).alias("disagreement"))


# joins

RULES_SQL = "r AS (SELECT 'src' || i AS source, i % 2 = 0 AS required FROM range(24) t(i))"


def rules(spark: SparkSession) -> DataFrame:
    return spark.range(24).select(F.concat(F.lit("src"), F.col("id")).alias("source"), (F.col("id") % 2 == 0).alias("required"))


@query(
    "j1_rule_matches",
    f"WITH {RULES_SQL}, c AS (SELECT source, count(*) AS n FROM documents WHERE n_chars > 6000 GROUP BY 1) SELECT r.source, r.required, coalesce(c.n, 0) AS n_matches, CASE WHEN c.n = 1 THEN 'mapped' WHEN c.n > 1 THEN 'ambiguous' WHEN r.required THEN 'missing' ELSE 'absent' END AS state FROM r LEFT JOIN c USING (source)",
)
def j1(spark: SparkSession, sf: str) -> DataFrame:
    """Rules against sections by key, with checked cardinality; sections are counted before the join."""
    return joins.matched(rules(spark), table(spark, sf, "documents").filter("n_chars > 6000"), "source", F.col("required"))


@query("f3_unmapped", f"WITH {RULES_SQL} SELECT d.doc_id, d.source FROM documents d ANTI JOIN (SELECT * FROM r WHERE required) r USING (source)")
def f3(spark: SparkSession, sf: str) -> DataFrame:
    """Sections that no rule names."""
    return table(spark, sf, "documents").select("doc_id", "source").join(F.broadcast(rules(spark).filter("required")), "source", "left_anti")


@query("j26_poisoned_records", f"WITH {RULES_SQL} SELECT DISTINCT lang FROM documents d ANTI JOIN (SELECT * FROM r WHERE required) r USING (source)")
def j26(spark: SparkSession, sf: str) -> DataFrame:
    return joins.poisoned(table(spark, sf, "documents"), rules(spark).filter("required"), "source", "lang")


@query(
    "j3_provenance_match",
    "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing-provenance' WHEN d.doc_id IS NULL THEN 'orphan' ELSE 'paired' END AS state FROM (SELECT doc_id FROM documents WHERE lang = 'en') d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id",
)
def j3(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").filter("lang = 'en'").select("doc_id", F.lit(1).alias("d"))
    l = table(spark, sf, "labels").select("doc_id").distinct().withColumn("l", F.lit(1))
    return d.join(l, "doc_id", "full_outer").select("doc_id", F.when(F.col("l").isNull(), "missing-provenance").when(F.col("d").isNull(), "orphan").otherwise("paired").alias("state"))


@query(
    "j5_overlap",
    f"WITH {SPANS_SQL}, w AS (SELECT doc_id, pos, s, e + CASE WHEN pos % 3 = 1 THEN 5 ELSE 0 END AS e FROM spans), l AS (SELECT *, lag(e) OVER d AS be, lag(pos) OVER d AS bo FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY s, e, pos)) SELECT doc_id, pos, bo AS other FROM l WHERE s < be AND pos <> bo",
)
def j5(spark: SparkSession, sf: str) -> DataFrame:
    """Overlap of neighbouring spans of different sections."""
    wide = spans(spark, sf).withColumn("e", F.col("e") + F.when(F.col("pos") % 3 == 1, 5).otherwise(0))
    return span_ops.neighbours_overlap(wide, ["doc_id"], "pos").select("doc_id", "pos", F.col("before_owner").alias("other"))


@query("j6_dangling_references", "SELECT l.l_orderkey, l.l_partkey FROM lineitem l ANTI JOIN (SELECT p_partkey FROM part WHERE p_size < 40) p ON l.l_partkey = p.p_partkey")
def j6(spark: SparkSession, sf: str) -> DataFrame:
    """References that name nothing."""
    p = table(spark, sf, "part").filter("p_size < 40").select("p_partkey")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(p, F.col("l_partkey") == F.col("p_partkey"), "left_anti")


@query(
    "j7_first_holder",
    "SELECT p.p_partkey, s.s_name AS holder, n.n_name AS country FROM part p LEFT JOIN (SELECT l_partkey, arg_min(l_suppkey, (l_orderkey, l_linenumber)) AS k FROM lineitem GROUP BY 1) l ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON s.s_suppkey = l.k LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey",
)
def j7(spark: SparkSession, sf: str) -> DataFrame:
    """The first holder of each authorisation; the big side is reduced before it is joined. Lines without a holder
    are passed over, missing numbers come last, and of lines with equal numbers the first of the file is taken."""
    number = lambda c: [F.col(c).isNull().alias(f"no_{c}"), F.col(c)]
    place = F.struct(*number("l_orderkey"), *number("l_linenumber"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    held = table(spark, sf, "lineitem").filter("l_suppkey IS NOT NULL")
    first = held.groupBy("l_partkey").agg(F.min_by("l_suppkey", place).alias("k"))
    s = table(spark, sf, "supplier").join(joins.small(table(spark, sf, "nation")), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    p = table(spark, sf, "part").select("p_partkey").join(first, F.col("p_partkey") == F.col("l_partkey"), "left")
    return p.join(s, F.col("k") == F.col("s_suppkey"), "left").select("p_partkey", F.col("s_name").alias("holder"), F.col("n_name").alias("country"))


@query(
    "j8_set_equality",
    "WITH a AS (SELECT c_nationkey AS label, array_to_string(list_sort(list(DISTINCT c_mktsegment)), '|') AS m FROM customer WHERE c_acctbal > 9000 GROUP BY 1), b AS (SELECT c_nationkey AS product, array_to_string(list_sort(list(DISTINCT c_mktsegment)), '|') AS m FROM customer WHERE c_acctbal < 0 GROUP BY 1) SELECT a.label, count(b.product) AS n_products, CASE count(b.product) WHEN 0 THEN 'new' WHEN 1 THEN 'known' ELSE 'error' END AS state FROM a LEFT JOIN b ON a.m = b.m GROUP BY 1",
)
def j8(spark: SparkSession, sf: str) -> DataFrame:
    """Labels whose set of numbers equals a product's: none is new, several is an error."""
    of = lambda which, name: table(spark, sf, "customer").filter(which).groupBy(F.col("c_nationkey").alias(name)).agg(F.collect_set("c_mktsegment").alias("m"))
    n = F.count("product")
    return joins.set_equality(of("c_acctbal > 9000", "label"), of("c_acctbal < 0", "product"), "m").groupBy("label").agg(n.alias("n_products"), F.when(n == 0, "new").when(n == 1, "known").otherwise("error").alias("state"))


@query("j11_outside_places", f"WITH {SPANS_SQL}, o AS (SELECT * FROM spans WHERE e - s > 120), i AS (SELECT doc_id, pos, s + 2 AS s, e - 2 AS e FROM spans WHERE e - s > 8) SELECT i.doc_id, i.pos FROM i WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.doc_id = i.doc_id AND o.s <= i.s AND i.e <= o.e)")
def j11(spark: SparkSession, sf: str) -> DataFrame:
    """Places that no other place contains: an anti join by document with range conditions."""
    all_spans = spans(spark, sf)
    inner = all_spans.filter("e - s > 8").select("doc_id", "pos", (F.col("s") + 2).alias("s"), (F.col("e") - 2).alias("e"))
    return span_ops.outside(inner, all_spans.filter("e - s > 120"), ["doc_id"]).select("doc_id", "pos")


@query("j15_as_of", "SELECT o.o_orderkey, max(e.ts) AS as_of FROM orders o LEFT JOIN events e ON e.user_id = o.o_custkey % 50 AND e.ts <= TIMESTAMP '2024-01-10' + to_days(CAST(o.o_orderkey % 15 AS INT)) GROUP BY 1")
def j15(spark: SparkSession, sf: str) -> DataFrame:
    """As-of: the newest entry at or before a time. Keys are cut into days: a running maximum inside each
    day, and the newest entry of all days before, carried along a key's few days. So a key with very many
    entries is as many tasks as it has days."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("k"), "ts", F.to_date("ts").alias("day"), F.lit(None).cast("long").alias("o_orderkey"))
    at = F.expr("timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(cast(o_orderkey % 15 as int))")
    o = table(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("k"), at.alias("ts"), F.to_date(at).alias("day"), "o_orderkey")
    both = e.unionByName(o)
    is_event = F.col("o_orderkey").isNull()
    days = both.groupBy("k", "day").agg(F.max(F.when(is_event, F.col("ts"))).alias("newest"))
    carried = days.select("k", "day", F.max("newest").over(Window.partitionBy("k").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    inside = Window.partitionBy("k", "day").orderBy("ts", F.col("o_orderkey").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("own", F.max(F.when(is_event, F.col("ts"))).over(inside)).filter("o_orderkey IS NOT NULL")
    return seen.join(carried, ["k", "day"]).select("o_orderkey", F.coalesce("own", "carried").alias("as_of"))


@query("j18_agreed_facts", "SELECT l_partkey, any_value(l_suppkey) AS supplier FROM lineitem WHERE l_quantity > 45 GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1")
def j18(spark: SparkSession, sf: str) -> DataFrame:
    """Facts on which all rows agree; conflicting ones are dropped."""
    g = table(spark, sf, "lineitem").filter("l_quantity > 45").groupBy("l_partkey").agg(F.min("l_suppkey").alias("supplier"), F.max("l_suppkey").alias("other"))
    return g.filter("supplier = other").select("l_partkey", "supplier")


@query("j22_positional_merge", "WITH a AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n FROM lineitem), b AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n FROM lineitem WHERE l_returnflag <> 'R') SELECT a.l_orderkey, a.n AS place, a.l_partkey IS NOT DISTINCT FROM b.l_partkey AS same FROM a LEFT JOIN b USING (l_orderkey, n)")
def j22(spark: SparkSession, sf: str) -> DataFrame:
    """Drawn against stored elements by position."""
    li = table(spark, sf, "lineitem")
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey"))
    a = li.select("l_orderkey", "l_partkey", n.alias("place"))
    b = li.filter("l_returnflag <> 'R'").select("l_orderkey", F.col("l_partkey").alias("drawn"), n.alias("place"))
    return a.join(b, ["l_orderkey", "place"], "left").select("l_orderkey", F.col("place").cast("long").alias("place"), F.col("l_partkey").eqNullSafe(F.col("drawn")).alias("same"))


@query("j27_validation_list", "SELECT p_partkey, unnest(string_split(p_type, ' ')) AS profile FROM part")
def j27(spark: SparkSession, sf: str) -> DataFrame:
    """Every resource with each of its profiles."""
    return table(spark, sf, "part").select("p_partkey", F.explode(F.split("p_type", " ")).alias("profile"))


@query("j24_section_ids", f"WITH {SECTIONS_SQL}, h AS (SELECT doc_id, pos, sha256('section:' || doc_id || '/' || pos) AS h FROM sections) SELECT doc_id, pos, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-a' || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS section_id FROM h")
def j24(spark: SparkSession, sf: str) -> DataFrame:
    """Stable section ids, computed from document and place."""
    return sections(spark, sf).select("doc_id", "pos", hashing.stable_uuid("section", F.concat_ws("/", F.col("doc_id").cast("string"), F.col("pos").cast("string"))).alias("section_id"))


# order and limits


@query("l1_limited_scan", "WITH h AS (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 200) SELECT doc_id FROM h WHERE contains(text, 'the') ORDER BY doc_id LIMIT 50")
def l1(spark: SparkSession, sf: str) -> DataFrame:
    """A horizon, a filter, a limit."""
    return table(spark, sf, "documents").select("doc_id", "text").orderBy("doc_id").limit(200).filter(F.contains("text", F.lit("the"))).orderBy("doc_id").limit(50).select("doc_id")


@query("l3_rule_order", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS present FROM orders GROUP BY 1")
def l3(spark: SparkSession, sf: str) -> DataFrame:
    """What is present, in the order of the rules."""
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("present"))


@query("l5_canonical_order", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS place FROM events WHERE event_type IN ('error', 'signup')")
def l5(spark: SparkSession, sf: str) -> DataFrame:
    """Findings in canonical order, each with its place: rows, not one list a key."""
    e = table(spark, sf, "events").filter(F.col("event_type").isin("error", "signup"))
    return e.select("user_id", "event_id", F.row_number().over(Window.partitionBy("user_id").orderBy("event_type", "event_id")).cast("long").alias("place"))


@query("l6_capped_lists", "SELECT l_partkey, array_to_string(list_slice(list_sort(list(DISTINCT l_suppkey)), 1, 20), ',') AS identifiers FROM lineitem GROUP BY 1")
def l6(spark: SparkSession, sf: str) -> DataFrame:
    """The first twenty identifiers of each product: a rank limit below the shuffle, then lists of bounded length."""
    pairs = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    first = pairs.withColumn("n", F.row_number().over(Window.partitionBy("l_partkey").orderBy("l_suppkey"))).filter("n <= 20")
    return first.groupBy("l_partkey").agg(F.array_join(F.array_sort(F.collect_list("l_suppkey")), ",").alias("identifiers"))


# sets


@query("u2_except", "SELECT l_partkey AS k FROM lineitem EXCEPT SELECT p_partkey FROM part WHERE p_size > 20")
def u2(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k")).subtract(table(spark, sf, "part").filter("p_size > 20").select("p_partkey"))


@query(
    "u3_shingle_overlap",
    "WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL), b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM benchmark), ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' '))) AS s FROM w WHERE len(w) >= 8), bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' '))) AS s FROM b WHERE len(w) >= 8) SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY 1, 2",
)
def u3(spark: SparkSession, sf: str) -> DataFrame:
    """Shared runs of eight words: a 64-bit hash a run, made of the words' hashes, the benchmark's against all
    documents'. No words are shuffled, and documents' runs not at all while the benchmark is small. Runs whose
    hashes are equal count as equal."""

    def of(name: str, key: str) -> DataFrame:
        hashes = F.array(F.transform(text.words(F.col("text")), lambda w: F.xxhash64(w)))
        run = lambda h, i: F.xxhash64(*[F.get(h, i + k) for k in range(8)])
        runs = F.flatten(F.transform(hashes, lambda h: F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - 7, F.lit(0))), lambda x, i: run(h, i))))
        return table(spark, sf, name).filter("text IS NOT NULL").select(key, F.explode(F.array_distinct(runs)).alias("r"))

    return of("documents", "doc_id").join(joins.small(of("benchmark", "item_id"), 100_000), "r").groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_shared"))


@query("u5_issue_union", "SELECT doc_id, 'short' AS issue FROM documents WHERE n_chars < 100 UNION ALL SELECT doc_id, 'unlabelled' FROM documents ANTI JOIN labels USING (doc_id)")
def u5(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return d.filter("n_chars < 100").select("doc_id", F.lit("short").alias("issue")).unionByName(d.join(table(spark, sf, "labels"), "doc_id", "left_anti").select("doc_id", F.lit("unlabelled").alias("issue")))


@query("u6_distinct", "SELECT DISTINCT p_brand, p_size FROM part")
def u6(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_brand", "p_size").distinct()


@query("u7_lock_union", "WITH u AS (SELECT l_partkey AS ref, l_suppkey AS sha FROM lineitem WHERE l_linenumber = 1 UNION SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linenumber = 2) SELECT ref, count(DISTINCT sha) AS n_hashes FROM u GROUP BY 1 HAVING count(DISTINCT sha) > 1")
def u7(spark: SparkSession, sf: str) -> DataFrame:
    """Two locks put together; one reference with two hashes is an error."""
    of = lambda n: table(spark, sf, "lineitem").filter(F.col("l_linenumber") == n).select(F.col("l_partkey").alias("ref"), F.col("l_suppkey").alias("sha"))
    return of(1).unionByName(of(2)).groupBy("ref").agg(F.count_distinct("sha").alias("n_hashes")).filter("n_hashes > 1")
