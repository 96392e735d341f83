"""Template checks and implementation reports over the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quoting, templates, text
from ..operators import resemblance, search
from ..operators.joins import small
from ..sources.tables import table
from .edges_sql import WHITE, normal
from .model import SECTIONS_SQL, sections
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql

# template checks


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """item_id, template, pattern, anchor: statements made of the benchmark passages. Their first fourteen words,
    the third a fill-in, the sixth and seventh optional, guidance at the end. Templates are few (a registry);
    they are parsed on the driver."""
    rows = table(spark, sf, "benchmark").select("item_id", F.split(text.collapse(F.col("text")), " ").alias("w")).filter(F.size("w") >= 14).limit(20_001).collect()
    if len(rows) > 20_000:
        raise ValueError("a registry holds at most 20,000 statements")
    safe = lambda w: "".join(c for c in w if c not in "{}<>[]")
    made = []
    for r in rows:
        w = [safe(x) for x in r["w"][:14]]
        t = f"{w[0]} {w[1]} {{name}} {w[3]} {w[4]} <{w[5]} {w[6]} >{' '.join(w[7:14])}[as approved]"
        made.append((r["item_id"], t, templates.pattern(t), templates.anchor(t)))
    return spark.createDataFrame(made, "item_id long, template string, pattern string, anchor string")


_W = f"string_split(trim(regexp_replace(text, '[{WHITE}]+', ' ', 'g')), ' ')"
_TEMPLATE_SQL = f"""{SECTIONS_SQL}, w AS (SELECT item_id, list_transform({_W}, lambda x: regexp_replace(x, '[{{}}<>\\[\\]]', '', 'g')) AS w FROM benchmark WHERE len({_W}) >= 14),
e AS (SELECT item_id, list_transform(w, lambda x: regexp_escape(x)) AS w FROM w),
rx AS (SELECT item_id, '[' || lower(left(w[1], 1)) || upper(left(w[1], 1)) || ']' || substr(w[1], 2) || '\\s+' || w[2] || '\\s+(?s:.{{1,300}}?)\\s+' || w[4] || '\\s+' || w[5] || '\\s+(?:' || w[6] || '\\s+' || w[7] || '\\s+)?' || array_to_string(w[8:14], '\\s+') AS rx FROM e),
win AS (SELECT doc_id, pos, body || coalesce(chr(10) || lead(body) OVER (PARTITION BY doc_id ORDER BY pos), '') AS joined FROM sections)"""


@query("p2_template_search", f"WITH {_TEMPLATE_SQL} SELECT item_id, doc_id, min(pos) AS pos FROM win JOIN rx ON regexp_matches(joined, rx) GROUP BY 1, 2")
def p2(spark: SparkSession, sf: str) -> DataFrame:
    """The first window of two lines of each document that holds each statement. The longest required run of
    words is looked up by an equi-join on hashed words first; patterns run on those documents only."""
    r = registry(spark, sf)
    s = sections(spark, sf)
    docs = table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", text.collapse(F.col("text")).alias("body"))
    pairs = search.phrase_pairs(docs, ["doc_id"], "body", r, "item_id", "anchor")
    some = s.join(small(pairs.select("doc_id").distinct(), 100_000), "doc_id", "left_semi").select("doc_id", "pos", "body")
    after = some.select("doc_id", (F.col("pos") - 1).alias("pos"), F.col("body").alias("after"))
    windows = some.join(after, ["doc_id", "pos"], "left").select("doc_id", "pos", F.concat_ws("\n", "body", "after").alias("joined"))
    asked = pairs.join(small(r.select("item_id", "pattern")), "item_id")
    hit = windows.join(small(asked, 100_000), "doc_id").filter(F.regexp_like("joined", F.col("pattern")))
    return hit.groupBy("item_id", "doc_id").agg(F.min("pos").alias("pos"))


HEADINGS = {1: "4.1 <Therapeutic >indications", 2: "<Name of the >medicine(s)", 3: "Posology <and method <of administration>>", 4: "Contents of the pack"}
FORMS = [
    (1, "4.1 Therapeutic indications"), (1, "4.1 indications"), (2, "Name of the medicine(s)"), (2, "medicine(s)"), (3, "Posology"), (3, "Posology and method"),
    (3, "Posology and method of administration"), (4, "Contents of the pack"),
]


@query("p13_heading_forms", "SELECT * FROM (VALUES " + ", ".join(f"({k}, '{f}')" for k, f in FORMS) + ") t(template, form)")
def p13(spark: SparkSession, sf: str) -> DataFrame:
    """Optional parts of template headings expanded on the driver, nested ones too."""
    return spark.createDataFrame([(k, f) for k, t in HEADINGS.items() for f in templates.forms(t)], "template int, form string")


def _words(c: str) -> Column:
    return F.split(F.lower(text.collapse(F.col(c))), " ")


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").filter("text IS NOT NULL").select("conv_id", "turn", _words("text").alias("words"))


@query("p3_resemblance")
def p3(spark: SparkSession, sf: str) -> DataFrame:
    """Whole passages against all stretches of whole turns: pairs that reach the score, with it."""
    b = table(spark, sf, "benchmark").select("item_id", _words("text").alias("words"))
    return resemblance.resembling(b, "item_id", _turns(spark, sf), ["conv_id", "turn"]).select("conv_id", "turn", "item_id", F.round("score", 6).alias("score"))


_P4_SQL = f"SELECT item_id, list_distinct(string_split(lower(trim(regexp_replace(text, '[{WHITE}]+', ' ', 'g'))), ' ')) AS w FROM benchmark"


@query(
    "p4_bag_bound",
    f"WITH b AS ({_P4_SQL}), p AS (SELECT a.item_id, o.item_id AS other, len(list_intersect(a.w, o.w)) AS n_shared, len(a.w) AS n FROM b a JOIN b o ON a.item_id <> o.item_id) SELECT item_id, other, n_shared FROM p WHERE n_shared >= 0.15 * n",
)
def p4(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of passages of which the second holds at least three twentieths of the first's words: found by the rarest
    words of each, never by the common ones."""
    b = table(spark, sf, "benchmark").select("item_id", F.array_distinct(_words("text")).alias("words"))
    other = b.select(F.col("item_id").alias("other"), "words")
    pairs = resemblance.bounded_pairs(b, "item_id", other, ["other"], 0.15).filter("item_id <> other")
    both = pairs.join(b, "item_id").join(other.withColumnRenamed("words", "other_words"), "other")
    return both.select("item_id", "other", F.size(F.array_intersect("words", "other_words")).cast("long").alias("n_shared"))


@query("t6_template_report")
def t6(spark: SparkSession, sf: str) -> DataFrame:
    """Each statement over all turns: how many hold it, how many come near it (deviations), how many lack it."""
    r = registry(spark, sf)
    turns = table(spark, sf, "conversations").filter("text IS NOT NULL").select("conv_id", "turn", "text", text.collapse(F.col("text")).alias("body"))
    pairs = search.phrase_pairs(turns, ["conv_id", "turn"], "body", r, "item_id", "anchor")
    asked = turns.join(small(pairs, 100_000), ["conv_id", "turn"]).join(small(r.select("item_id", "pattern")), "item_id")
    present = asked.filter(F.regexp_like("text", F.col("pattern"))).select("item_id", "conv_id", "turn")
    # What a statement requires, word by word; a fill-in stands for no word.
    required = r.select("item_id", F.split(F.lower(F.regexp_replace(F.regexp_replace("template", r"\{[^}]*\}|\[[^\]]*\]|[<>]", " "), r"\s+", " ")), " ").alias("words"))
    required = required.withColumn("words", F.filter("words", lambda w: w != ""))
    near = resemblance.resembling(required, "item_id", _turns(spark, sf), ["conv_id", "turn"]).join(present, ["item_id", "conv_id", "turn"], "left_anti")
    kinds = present.withColumn("kind", F.lit("present")).unionByName(near.select("item_id", "conv_id", "turn").withColumn("kind", F.lit("deviating")))
    per = kinds.groupBy("item_id").agg(F.count_if(F.col("kind") == "present").alias("present"), F.count_if(F.col("kind") == "deviating").alias("deviating"))
    total = turns.agg(F.count(F.lit(1)).alias("n"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = r.select("item_id").join(per, "item_id", "left").crossJoin(F.broadcast(total))  # one row
    return out.select("item_id", zero("present").alias("present"), zero("deviating").alias("deviating"), (F.col("n") - zero("present") - zero("deviating")).alias("missing"))


# implementation reports

#: The changed word of each passage, and what it becomes. Odd items change back: their labels hold the new wording.
PLACE, AMENDED = 5, "amended"


def edits(spark: SparkSession, sf: str) -> DataFrame:
    """item_id, edit_id, old, new: one change of a word a passage, worded with as much context as makes it unique."""
    b = table(spark, sf, "benchmark").select("item_id", text.normalize(F.col("text")).alias("body")).filter(F.size(F.split("body", " ")) > PLACE)
    w = b.withColumn("w", quoting.wordings(F.col("body"), F.lit(PLACE), F.lit(AMENDED)))
    back = F.col("item_id") % 2 == 1
    e = w.select("item_id", F.when(back, F.col("w.new")).otherwise(F.col("w.old")).alias("old"), F.when(back, F.col("w.old")).otherwise(F.col("w.new")).alias("new"))
    return e.select("item_id", F.substring(F.sha2(F.concat("old", F.lit("\0"), "new"), 256), 1, 12).alias("edit_id"), "old", "new")


EDITS_SQL = f"""bw AS (SELECT item_id, {normal('text')} AS body, string_split({normal('text')}, ' ') AS w FROM benchmark),
ctx AS (SELECT item_id, body, w, k, array_to_string(w[greatest(1, {PLACE} + 1 - k):{PLACE} + 1 + k], ' ') AS old, array_to_string(list_concat(list_concat(w[greatest(1, {PLACE} + 1 - k):{PLACE}], ['{AMENDED}']), w[{PLACE} + 2:{PLACE} + 1 + k]), ' ') AS new FROM bw, range(2, 60) t(k) WHERE len(w) > {PLACE}),
one AS (SELECT item_id, arg_min(old, k) AS o, arg_min(new, k) AS n FROM ctx WHERE (length(body) - length(replace(body, old, ''))) / length(old) <= 1 OR ({PLACE} + 1 - k <= 1 AND {PLACE} + 1 + k >= len(w)) GROUP BY 1),
edits AS (SELECT item_id, CASE WHEN item_id % 2 = 1 THEN n ELSE o END AS old, CASE WHEN item_id % 2 = 1 THEN o ELSE n END AS new FROM one)"""


@query("p7_edit_wordings", f"WITH {EDITS_SQL} SELECT item_id, substr(sha256(encode(old) || '\\x00'::BLOB || encode(new)), 1, 12) AS edit_id, old, new FROM edits")
def p7(spark: SparkSession, sf: str) -> DataFrame:
    """Edits with their ids and wordings, whose context grows until the old wording is unique."""
    return edits(spark, sf)


def places(labels: DataFrame, key: list[str], body: str, wordings: DataFrame, wording_id: str, wording: str) -> DataFrame:
    """key, wording_id: the texts that contain a wording, both normalised. Its inner words stand between spaces in
    any such text, so an equi-join on their hashes finds all candidates (wordings have at least four words);
    only candidates are normalised again and searched."""
    inner = wordings.withColumn("inner", F.array_join(F.slice(F.split(wording, " "), F.lit(2), F.size(F.split(wording, " ")) - 2), " "))
    ready = labels.withColumn(body, text.normalize(F.col(body))).filter(F.col(body).isNotNull())
    pairs = search.phrase_pairs(ready, key, body, inner.select(wording_id, "inner"), wording_id, "inner")
    some = labels.join(small(pairs, 100_000), key).withColumn(body, text.normalize(F.col(body)))
    both = some.join(small(wordings.select(wording_id, wording)), wording_id)
    return both.filter(F.contains(F.col(body), F.col(wording))).select(*key, wording_id)


def statuses(spark: SparkSession, sf: str, labels: DataFrame, key: list[str], body: str) -> DataFrame:
    """item_id, key, in_old, in_new: which wordings of each edit a label holds, where it holds any."""
    e = edits(spark, sf)
    both = e.select((F.col("item_id") * 2).alias("wid"), F.col("old").alias("wording")).unionByName(e.select((F.col("item_id") * 2 + 1).alias("wid"), F.col("new").alias("wording")))
    hit = places(labels, key, body, both, "wid", "wording")
    new = F.col("wid") % 2 == 1
    return hit.groupBy(F.expr("wid DIV 2").alias("item_id"), *key).agg(F.bool_or(~new).alias("in_old"), F.bool_or(new).alias("in_new"))


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.col("text").alias("body"))


@query(
    "j10_edit_places",
    f"WITH {EDITS_SQL}, l AS (SELECT doc_id, {normal('text')} AS body FROM documents) SELECT item_id, doc_id, contains(body, old) AS in_old, contains(body, new) AS in_new FROM l JOIN edits ON contains(body, old) OR contains(body, new)",
)
def j10(spark: SparkSession, sf: str) -> DataFrame:
    """Which labels hold the old and the new wording of each edit."""
    return statuses(spark, sf, _labels(spark, sf), ["doc_id"], "body").select("item_id", "doc_id", "in_old", "in_new")


#: A label without a date is not checked for lateness; refused ones are not read.
_STATUS_SQL = "CASE WHEN source = 'src3' THEN 'refused' WHEN lang <> 'en' THEN 'not-checked' WHEN in_old AND in_new THEN 'both' WHEN in_new THEN 'implemented' WHEN in_old THEN 'pending' ELSE 'absent' END"


@query(
    "p9_edit_status",
    f"WITH {EDITS_SQL}, l AS (SELECT doc_id, source, lang, {normal('text')} AS body FROM documents), m AS (SELECT item_id, doc_id, source, lang, coalesce(contains(body, old), false) AS in_old, coalesce(contains(body, new), false) AS in_new FROM l CROSS JOIN edits), s AS (SELECT item_id, {_STATUS_SQL} AS status FROM m) SELECT item_id, status, count(*) AS n FROM s GROUP BY 1, 2",
)
def p9(spark: SparkSession, sf: str) -> DataFrame:
    """Labels by status of each edit, in the order of the rule: refused, not checked (other language), then what
    it holds. Labels that hold neither wording are counted, not paired with the edits."""
    d = table(spark, sf, "documents").select("doc_id", "source", "lang")
    gate = F.when(F.col("source") == "src3", "refused").when(F.col("lang") != "en", "not-checked")
    held = statuses(spark, sf, _labels(spark, sf), ["doc_id"], "body").join(d, "doc_id")
    status = F.coalesce(gate, F.when(F.col("in_old") & F.col("in_new"), "both").when(F.col("in_new"), "implemented").otherwise("pending"))
    seen = held.groupBy("item_id", status.alias("status")).agg(F.count(F.lit(1)).alias("n"))
    totals = d.groupBy(F.coalesce(gate, F.lit("absent")).alias("status")).agg(F.count(F.lit(1)).alias("total"))
    every = edits(spark, sf).select("item_id").crossJoin(F.broadcast(totals))  # at most three rows
    # Gated labels count under their gate wholly; of the others, those that hold a wording are not absent.
    holding = seen.filter(~F.col("status").isin("refused", "not-checked")).groupBy("item_id").agg(F.sum("n").alias("holding"))
    rest = every.join(holding, "item_id", "left").select("item_id", "status", (F.col("total") - F.when(F.col("status") == "absent", F.coalesce("holding", F.lit(0))).otherwise(0)).alias("n")).filter("n > 0")
    return rest.unionByName(seen.filter(~F.col("status").isin("refused", "not-checked")))


@query(
    "t7_implementation_report",
    f"WITH {EDITS_SQL}, l AS (SELECT {normal('text')} AS body FROM documents), h AS (SELECT item_id, count(*) FILTER (contains(body, new) AND NOT contains(body, old)) AS implemented, count(*) FILTER (contains(body, old) AND NOT contains(body, new)) AS pending, count(*) FILTER (contains(body, old) AND contains(body, new)) AS \"both\" FROM l JOIN edits ON contains(body, old) OR contains(body, new) GROUP BY 1) SELECT e.item_id, coalesce(implemented, 0) AS implemented, coalesce(pending, 0) AS pending, coalesce(\"both\", 0) AS \"both\" FROM edits e LEFT JOIN h USING (item_id)",
)
def t7(spark: SparkSession, sf: str) -> DataFrame:
    """Status counts of each edit over all labels."""
    held = statuses(spark, sf, _labels(spark, sf), ["doc_id"], "body")
    o, n = F.col("in_old"), F.col("in_new")
    per = held.groupBy("item_id").agg(F.count_if(n & ~o).alias("implemented"), F.count_if(o & ~n).alias("pending"), F.count_if(o & n).alias("both"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return edits(spark, sf).select("item_id").join(per, "item_id", "left").select("item_id", zero("implemented"), zero("pending"), zero("both"))


@query("p8_occurrences", "SELECT doc_id, len(list_filter(range(1, length(text) + 1), lambda i: substr(text, i, 3) = 'ana')) AS n FROM documents WHERE text IS NOT NULL AND contains(text, 'ana')")
def p8(spark: SparkSession, sf: str) -> DataFrame:
    """All places of a wording, overlapping ones too (a match of no width before each)."""
    d = table(spark, sf, "documents").filter(F.contains("text", F.lit("ana")))
    return d.select("doc_id", F.regexp_count("text", F.lit("(?=ana)")).cast("long").alias("n"))


def amended(c: Column) -> Column:
    """A later version of a text: the second line changed, the fourth gone, one more at the end."""
    lines = F.split(c, "\n")
    changed = F.transform(lines, lambda x, i: F.when(i == 1, F.concat(x, F.lit(" amended"))).otherwise(x))
    kept = F.filter(changed, lambda x, i: i != 3)
    return F.array_join(F.concat(kept, F.array(F.lit("a closing line that was not there"))), "\n")


@query(
    "j19_version_diff",
    "SELECT doc_id, len(string_split(text, chr(10))) AS n_before, CASE WHEN len(string_split(text, chr(10))) > 3 THEN len(string_split(text, chr(10))) - 1 ELSE len(string_split(text, chr(10))) END + 1 AS n_after FROM documents WHERE text IS NOT NULL",
)
def j19(spark: SparkSession, sf: str) -> DataFrame:
    """Paragraphs of two versions aligned in order: what is kept, changed, inserted and deleted adds up to both sides."""
    d = table(spark, sf, "documents").filter("text IS NOT NULL").select("doc_id", "text", amended(F.col("text")).alias("later"))
    c = d.select("doc_id", quoting.aligned_paragraphs(F.col("text"), F.col("later")).alias("c"))
    return c.select("doc_id", F.expr("c.kept + c.changed + c.deleted").cast("long").alias("n_before"), F.expr("c.kept + c.changed + c.inserted").cast("long").alias("n_after"))
