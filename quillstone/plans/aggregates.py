"""Scoreboards, summaries and counts."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .model import SECTIONS_SQL, sections
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql

#: What a document of the tables counts as on the scoreboard, by size and language.
BUCKETS = ("whole", "built", "refused", "unclear")


def bucket():
    n = F.coalesce(F.length("text"), F.lit(0))
    return F.when(n < 60, "refused").when(n < 400, "unclear").when(n < 2500, "built").otherwise("whole")


BUCKET_SQL = "CASE WHEN coalesce(length(text), 0) < 60 THEN 'refused' WHEN length(text) < 400 THEN 'unclear' WHEN length(text) < 2500 THEN 'built' ELSE 'whole' END"


#: The later release of the regression query: one source arrives cut.
CUT_SQL = "left(text, CASE WHEN source = 'src3' THEN 300 ELSE 1000000 END)"


@query(
    "a3_bucket_counts",
    f"WITH b AS (SELECT lang, {BUCKET_SQL} AS bucket FROM documents), d AS (SELECT unnest(['whole', 'built', 'refused', 'unclear', 'absent']) AS bucket), l AS (SELECT DISTINCT lang FROM documents) SELECT l.lang, d.bucket, count(b.bucket) AS n_files FROM l CROSS JOIN d LEFT JOIN b ON b.lang IS NOT DISTINCT FROM l.lang AND b.bucket = d.bucket GROUP BY 1, 2",
)
def a3(spark: SparkSession, sf: str) -> DataFrame:
    """Files a bucket, buckets without files too: conditional counts in one aggregation, then unpivoted."""
    names = (*BUCKETS, "absent")
    counted = table(spark, sf, "documents").groupBy("lang").agg(*[F.count_if(bucket() == b).alias(b) for b in names])
    return counted.unpivot("lang", list(names), "bucket", "n_files")


@query("a4_shares", f"SELECT source, round(count(*) FILTER ({BUCKET_SQL} = 'whole') / nullif(count(*) FILTER ({BUCKET_SQL} IN ('whole', 'built')), 0), 4) AS whole_share FROM documents GROUP BY source")
def a4(spark: SparkSession, sf: str) -> DataFrame:
    """Shares with four digits, null where nothing is measured."""
    whole, built = F.count_if(bucket() == "whole"), F.count_if(bucket().isin("whole", "built"))
    return table(spark, sf, "documents").groupBy("source").agg(F.round(F.try_divide(whole.cast("double"), built), 4).alias("whole_share"))


@query("a5_top_codes", "SELECT l_partkey AS code, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, code LIMIT 15")
def a5(spark: SparkSession, sf: str) -> DataFrame:
    """The fifteen most frequent codes, ties by code: a top-k, no global sort."""
    return table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("code")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "code").limit(15)


def unlock_order(blockers: dict[frozenset, int], steps: int, keep: bool) -> list[tuple[int, str, int]]:
    """Causes in the order that unlocks most: each step takes the cause whose removal leaves most files
    without any (keep=True), or that blocks most files still blocked (keep=False)."""
    left, order = dict(blockers), []
    for step in range(1, steps + 1):
        gain: dict[str, int] = {}
        for causes, n in left.items():
            for c in causes:
                gain[c] = gain.get(c, 0) + (n if not keep or len(causes) == 1 else 0)
        if not gain:
            break
        best = min(gain, key=lambda c: (-gain[c], c))
        order.append((step, best, gain[best]))
        merged: dict[frozenset, int] = {}
        for causes, n in left.items():
            rest = causes - {best}
            if rest:
                merged[rest] = merged.get(rest, 0) + n
        left = merged
    return order


def _causes(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, causes: the sorted reasons that hold a document back."""
    n = F.coalesce(F.length("text"), F.lit(0))
    has = lambda p: F.coalesce(F.contains("text", F.lit(p)), F.lit(False))
    named = {"short": n < 400, "long": n > 8000, "table": has("|"), "markup": has("<"), "digits": F.coalesce(F.col("text").rlike("[0-9]{4}"), F.lit(False)), "shout": has("!!")}
    return table(spark, sf, "documents").select("doc_id", F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in sorted(named.items())])).alias("causes"))


def _unlocked(spark: SparkSession, sf: str, keep: bool) -> DataFrame:
    # The sets of causes are few (at most 2 ** 6): they are counted distributed, the order is found on the driver.
    rows = _causes(spark, sf).filter("size(causes) > 0").groupBy("causes").count().collect()
    order = unlock_order({frozenset(r["causes"]): r["count"] for r in rows}, 20, keep)
    return spark.createDataFrame(order, "step int, cause string, n_files long")


@query("a6_unlock_order")
def a6(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy order in which causes unlock files."""
    return _unlocked(spark, sf, True)


@query("a22_lift_order")
def a22(spark: SparkSession, sf: str) -> DataFrame:
    """Greedy order by files still blocked."""
    return _unlocked(spark, sf, False)


@query("a7_small_cells", "SELECT source, lang, CASE WHEN count(*) < 5 THEN '<5' ELSE CAST(count(*) AS VARCHAR) END AS cell FROM documents GROUP BY 1, 2")
def a7(spark: SparkSession, sf: str) -> DataFrame:
    """Counts under five are not shown."""
    n = F.count(F.lit(1))
    return table(spark, sf, "documents").groupBy("source", "lang").agg(F.when(n < 5, "<5").otherwise(n.cast("string")).alias("cell"))


@query("a8_findings_by_kind", "SELECT event_type AS kind, count(*) AS n, count(DISTINCT user_id) AS n_documents FROM events GROUP BY 1")
def a8(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("n_documents"))


@query(
    "a9_edit_statuses",
    "WITH o AS (SELECT o_orderpriority AS edit, o_orderstatus AS status, c_mktsegment AS market, greatest(0, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02')) AS days FROM orders JOIN customer ON o_custkey = c_custkey) SELECT edit, count(*) FILTER (status = 'O') AS n_pending, count(*) FILTER (status = 'F') AS n_implemented, count(*) FILTER (status = 'P') AS n_both, count(*) FILTER (status = 'O' AND days > 900) AS n_late, array_to_string(list_sort(list(DISTINCT market) FILTER (status = 'O' AND days > 900)), ',') AS late_markets FROM o GROUP BY edit",
)
def a9(spark: SparkSession, sf: str) -> DataFrame:
    """Statuses of each edit over all labels, and where it is late: one pass of conditional aggregates."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    days = F.greatest(F.lit(0), F.datediff(F.lit("1998-08-02").cast("date"), F.col("o_orderdate").cast("date")))
    late = (F.col("o_orderstatus") == "O") & (days > 900)
    is_ = lambda s: F.count_if(F.col("o_orderstatus") == s)
    return o.groupBy(F.col("o_orderpriority").alias("edit")).agg(
        is_("O").alias("n_pending"), is_("F").alias("n_implemented"), is_("P").alias("n_both"), F.count_if(late).alias("n_late"),
        F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(late, F.col("c_mktsegment")))), ","), F.lit("")).alias("late_markets"),
    )


@query("a10_issue_severity", "SELECT user_id, count(*) FILTER (event_type = 'error') AS n_error, count(*) FILTER (event_type = 'click') AS n_warning, count(*) FILTER (event_type NOT IN ('error', 'click')) AS n_information FROM events GROUP BY 1")
def a10(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("event_type")
    return table(spark, sf, "events").groupBy("user_id").agg(F.count_if(t == "error").alias("n_error"), F.count_if(t == "click").alias("n_warning"), F.count_if(~t.isin("error", "click")).alias("n_information"))


@query(
    "a12_binding_hash",
    f"WITH {SECTIONS_SQL} SELECT doc_id, sha256('[' || string_agg('{{\"hash\":\"' || sha256(body) || '\",\"key\":\"section[' || pos || ']\"}}', ',' ORDER BY pos) || ']') AS binding FROM sections GROUP BY doc_id",
)
def a12(spark: SparkSession, sf: str) -> DataFrame:
    """Hash of the canonical JSON of all sections' keys and hashes, in order."""
    s = sections(spark, sf).select("doc_id", "pos", F.struct(F.sha2("body", 256).alias("hash"), F.col("path").alias("key")).alias("entry"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "entry"))), lambda x: x["entry"])
    return s.groupBy("doc_id").agg(F.sha2(F.to_json(ordered), 256).alias("binding"))


@query("a13_distinct_holders", "SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_size)), ',') AS sizes, count(DISTINCT p_type) AS n_types FROM part GROUP BY 1")
def a13(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_size")), ",").alias("sizes"), F.count_distinct("p_type").alias("n_types"))


@query("a14_duplicates", "SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def a14(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("a15_short_circuits", "SELECT source, bool_or(lang = 'fr') AS any_french, bool_and(n_chars > 10) AS all_long, min(CASE WHEN lang = 'de' THEN doc_id END) AS first_german FROM documents GROUP BY source")
def a15(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("source").agg(
        F.bool_or(F.col("lang") == "fr").alias("any_french"), F.bool_and(F.col("n_chars") > 10).alias("all_long"), F.min(F.when(F.col("lang") == "de", F.col("doc_id"))).alias("first_german")
    )


@query("a16_refusal_counts", f"SELECT lang, {BUCKET_SQL} AS code, count(*) AS n FROM documents WHERE {BUCKET_SQL} <> 'whole' GROUP BY 1, 2")
def a16(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").withColumn("code", bucket()).filter("code <> 'whole'").groupBy("lang", "code").agg(F.count(F.lit(1)).alias("n"))


@query("a17_character_totals", f"SELECT {BUCKET_SQL} AS bucket, CAST(sum(n_chars) AS BIGINT) AS n_characters, count(*) FILTER (n_chars IS NULL) AS n_unmeasurable FROM documents GROUP BY 1")
def a17(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy(bucket().alias("bucket")).agg(F.sum("n_chars").alias("n_characters"), F.count_if(F.col("n_chars").isNull()).alias("n_unmeasurable"))


@query(
    "a19_flags_by_priority",
    "WITH f AS (SELECT DISTINCT user_id, event_type, CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 3 ELSE 4 END AS p FROM events) SELECT user_id, string_agg(event_type, ',' ORDER BY p, event_type) AS flags FROM f GROUP BY 1",
)
def a19(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct flags in a fixed order of priority."""
    order = F.array(*[F.lit(x) for x in ("error", "purchase", "signup", "click")])
    g = table(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("seen"))
    rest = F.array_sort(F.array_except("seen", order))
    return g.select("user_id", F.array_join(F.concat(F.array_intersect(order, F.col("seen")), rest), ",").alias("flags"))


@query(
    "a21_first_and_any_refusal",
    "WITH c AS (SELECT doc_id, list_filter([CASE WHEN contains(coalesce(text, ''), '|') THEN 'table' END, CASE WHEN contains(coalesce(text, ''), '<') THEN 'markup' END, CASE WHEN contains(coalesce(text, ''), '!!') THEN 'shout' END], lambda x: x IS NOT NULL) AS causes FROM documents), e AS (SELECT doc_id, unnest(causes) AS cause, generate_subscripts(causes, 1) AS place FROM c) SELECT cause, count(*) FILTER (place = 1) AS n_first, count(DISTINCT doc_id) AS n_any FROM e GROUP BY 1",
)
def a21(spark: SparkSession, sf: str) -> DataFrame:
    has = lambda p, k: F.when(F.contains(F.coalesce("text", F.lit("")), F.lit(p)), F.lit(k))
    c = table(spark, sf, "documents").select("doc_id", F.posexplode(F.array_compact(F.array(has("|", "table"), has("<", "markup"), has("!!", "shout")))).alias("place", "cause"))
    return c.groupBy("cause").agg(F.count_if(F.col("place") == 0).alias("n_first"), F.count_distinct("doc_id").alias("n_any"))


@query(
    "a23_degraded_audit",
    "SELECT event_id, CASE WHEN value >= 0 AND value < 1000 THEN value END AS duration, CASE WHEN regexp_matches(event_type, '^[a-z]+$') THEN event_type END AS tool, NOT (coalesce(value >= 0 AND value < 1000, false) AND coalesce(regexp_matches(event_type, '^[a-z]+$'), false)) AS degraded FROM events",
)
def a23(spark: SparkSession, sf: str) -> DataFrame:
    """A refused optional field is dropped, the row never is."""
    good_value = F.coalesce((F.col("value") >= 0) & (F.col("value") < 1000), F.lit(False))
    good_tool = F.coalesce(F.col("event_type").rlike("^[a-z]+$"), F.lit(False))
    return table(spark, sf, "events").select("event_id", F.when(good_value, F.col("value")).alias("duration"), F.when(good_tool, F.col("event_type")).alias("tool"), (~(good_value & good_tool)).alias("degraded"))


@query(
    "j13_release_regression",
    f"WITH b AS (SELECT doc_id, {BUCKET_SQL} AS bucket, length(text) AS carried FROM documents WHERE text IS NOT NULL), a AS (SELECT doc_id, {BUCKET_SQL.replace('text', CUT_SQL)} AS bucket, length({CUT_SQL}) AS carried FROM documents WHERE text IS NOT NULL AND source <> 'src5') SELECT b.doc_id, CASE WHEN a.doc_id IS NULL THEN 'gone' WHEN a.bucket <> b.bucket THEN 'worse bucket' ELSE 'fewer carried' END AS regression FROM b LEFT JOIN a USING (doc_id) WHERE a.doc_id IS NULL OR a.bucket <> b.bucket OR a.carried < b.carried",
)
def j13(spark: SparkSession, sf: str) -> DataFrame:
    """What a release lost against the one before: files gone, in a worse bucket, or with less carried."""
    base = table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", "text", "source")
    before = base.select("doc_id", bucket().alias("was"), F.length("text").alias("had"))
    cut = base.filter("source <> 'src5'").withColumn("text", F.when(F.col("source") == "src3", F.substring("text", 1, 300)).otherwise(F.col("text")))
    after = cut.select("doc_id", bucket().alias("is"), F.length("text").alias("has"))
    kind = F.when(F.col("is").isNull(), "gone").when(F.col("is") != F.col("was"), "worse bucket").when(F.col("has") < F.col("had"), "fewer carried")
    return before.join(after, "doc_id", "left").select("doc_id", kind.alias("regression")).filter("regression IS NOT NULL")


@query("t8_scoreboard", f"SELECT coalesce(lang, 'all') AS lang, count(*) AS n_files, count(*) FILTER ({BUCKET_SQL} = 'whole') AS n_whole, round(count(*) FILTER ({BUCKET_SQL} = 'whole') / count(*), 4) AS share FROM documents WHERE lang IS NOT NULL GROUP BY ROLLUP (lang)")
def t8(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage by language and in all, by one rollup."""
    d = table(spark, sf, "documents").filter("lang IS NOT NULL").withColumn("whole", bucket() == "whole")
    g = d.rollup("lang").agg(F.count(F.lit(1)).alias("n_files"), F.count_if("whole").alias("n_whole"))
    return g.select(F.coalesce("lang", F.lit("all")).alias("lang"), "n_files", "n_whole", F.round(F.col("n_whole") / F.col("n_files"), 4).alias("share"))


@query(
    "t15_survey",
    """WITH c AS (SELECT doc_id, list_filter([CASE WHEN regexp_matches(text, '[0-9]{4}') THEN 'digits' END, CASE WHEN length(text) > 8000 THEN 'long' END, CASE WHEN contains(text, '<') THEN 'markup' END, CASE WHEN coalesce(length(text), 0) < 400 THEN 'short' END, CASE WHEN contains(text, '!!') THEN 'shout' END, CASE WHEN contains(text, '|') THEN 'table' END], lambda x: x IS NOT NULL) AS causes FROM documents),
e AS (SELECT doc_id, unnest(CASE WHEN len(causes) = 0 THEN ['none'] ELSE causes END) AS cause, len(causes) AS n FROM c) SELECT cause, count(*) AS n_files, count(*) FILTER (n <= 1) AS n_alone, median(n) AS median_causes FROM e GROUP BY 1""",
)
def t15(spark: SparkSession, sf: str) -> DataFrame:
    """Survey of a corpus: files of each cause, how many have no other, and the median number of causes beside it."""
    c = _causes(spark, sf)
    e = c.select(F.size("causes").alias("n"), F.explode_outer("causes").alias("cause"))
    per = e.groupBy(F.coalesce("cause", F.lit("none")).alias("cause"))
    return per.agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("n") <= 1).alias("n_alone"), F.median("n").alias("median_causes"))
