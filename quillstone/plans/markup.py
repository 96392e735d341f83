"""Narratives with tables, scripts and pictures; numbers, underlines and outlines of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text, xhtml
from ..sources.tables import table
from .model import SECTIONS_SQL, sections
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _div(inner: Column) -> Column:
    return F.concat(F.lit('<div xmlns="http://www.w3.org/1999/xhtml">'), inner, F.lit("</div>"))


@query(
    "x2_table_grid",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, row_number() OVER w AS n FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)),
t AS (SELECT l_orderkey, string_agg(chr(10) || chr(64978) || CASE WHEN n = 1 THEN chr(9) || chr(64979) || chr(9) || l_orderkey || chr(9) ELSE chr(9) || chr(64981) || chr(9) END || chr(9) || chr(64979) || chr(9) || l_partkey || chr(9) || chr(10), '' ORDER BY n) AS rows FROM r GROUP BY 1)
SELECT l_orderkey, sha256(chr(10) || chr(10) || chr(64976) || rows || chr(10) || chr(64977) || chr(10) || chr(10)) AS sha FROM t""",
)
def x2(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as tables whose first cell spans all rows, and read: the text carries the grid."""
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(order)).alias("r"))
    cell = lambda x: F.concat(F.lit("<td>"), x["l_partkey"].cast("string"), F.lit("</td>"))
    head = F.concat(F.lit('<td rowspan="'), F.size("r").cast("string"), F.lit('">'), F.col("l_orderkey").cast("string"), F.lit("</td>"))
    rows = F.transform("r", lambda x, i: F.concat(F.lit("<tr>"), F.when(i == 0, head).otherwise(""), cell(x), F.lit("</tr>")))
    return g.select("l_orderkey", F.sha2(xhtml.xhtml_to_text(_div(F.concat(F.lit("<table>"), F.array_join(rows, ""), F.lit("</table>"))))["text"], 256).alias("sha"))


@query(
    "x2_table_refusals",
    "SELECT l_orderkey, CASE WHEN count(*) = 1 THEN 'table-shape' WHEN max(l_orderkey) % 3 = 0 THEN 'table-shape' WHEN max(l_orderkey) % 3 = 1 THEN 'table-size' ELSE 'ok' END AS outcome FROM lineitem GROUP BY 1",
)
def x2b(spark: SparkSession, sf: str) -> DataFrame:
    """Tables that are no rectangles, or too large: a row too short, a cell that reaches below the last row, a span
    of too many slots."""
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("n"))
    k, n = F.col("l_orderkey") % 3, F.col("n")
    wide = F.when(k == 1, '<tr><td colspan="999" rowspan="999">x</td></tr>').otherwise("")
    last = F.when(k == 0, "<tr><td>x</td></tr>").otherwise("")
    rows = F.repeat(F.lit("<tr><td>a</td><td>b</td></tr>"), n)
    below = F.when(n == 1, '<tr><td rowspan="2">a</td><td>b</td></tr>').otherwise(F.concat(wide, rows, last))
    r = xhtml.xhtml_to_text(_div(F.concat(F.lit("<table>"), below, F.lit("</table>"))))
    return g.select("l_orderkey", r.alias("r")).select("l_orderkey", F.coalesce("r.error", F.lit("ok")).alias("outcome"))


@query(
    "x3_scripts",
    "SELECT p_partkey, sha256(chr(10) || 'c' || translate('-' || p_size, '-0123456789', '⁻⁰¹²³⁴⁵⁶⁷⁸⁹') || ' H' || translate('(' || p_size || ')', '()0123456789', '₍₎₀₁₂₃₄₅₆₇₈₉') || 'x' || chr(10)) AS sha FROM part",
)
def x3(spark: SparkSession, sf: str) -> DataFrame:
    """Raised and lowered numbers become script code points."""
    p = F.col("p_size").cast("string")
    inner = F.concat(F.lit("c<sup>-"), p, F.lit("</sup> H<sub>("), p, F.lit(")</sub>x"))
    return table(spark, sf, "part").select("p_partkey", F.sha2(xhtml.xhtml_to_text(_div(inner))["text"], 256).alias("sha"))


@query(
    "x5_pictures",
    "SELECT p_partkey, sha256(chr(10) || chr(10) || '<' || p_name || 'é&' || chr(10) || chr(65532) || sha256('data:image/png;base64,' || base64(encode(p_name))) || chr(65532) || chr(10)) AS sha FROM part",
)
def x5(spark: SparkSession, sf: str) -> DataFrame:
    """Character references, and pictures as the hash of their bytes between markers."""
    picture = F.concat(F.lit('<img src="data:image/png;base64,'), F.base64(F.col("p_name").cast("binary")), F.lit('"/>'))
    inner = F.concat(F.lit("<p>&lt;"), "p_name", F.lit("&#233;&amp;</p>"), picture)
    return table(spark, sf, "part").select("p_partkey", F.sha2(xhtml.xhtml_to_text(_div(inner))["text"], 256).alias("sha"))


@query("x1_xhtml_outcomes", "SELECT CASE WHEN starts_with(html, '<!DOCTYPE') THEN 'doctype' ELSE 'other' END AS outcome, count(*) AS n, 0 AS least_offset FROM pages GROUP BY 1")
def x1(spark: SparkSession, sf: str) -> DataFrame:
    """How the strict scanner takes the crawled pages: refusal codes, their number and first place."""
    read = table(spark, sf, "pages").select(xhtml.xhtml_to_text(F.col("html")).alias("r"))
    return read.groupBy(F.coalesce("r.error", F.lit("ok")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.min("r.offset").alias("least_offset"))


@query(
    "x6_narrative_status",
    f"WITH {SECTIONS_SQL} SELECT doc_id, pos, CASE WHEN regexp_matches(body, '[<&]') THEN 'unreadable' WHEN trim(body, ' \t\r') = '' THEN 'absent' ELSE 'present' END AS status FROM sections WHERE NOT regexp_matches(body, '[<&>]') OR regexp_matches(body, '^[^&<]*<[^A-Za-z/!?]|^[^&<]*&[^A-Za-z#]')",
)
def x6(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as narratives: nothing in them, unreadable markup, or text."""
    s = sections(spark, sf).filter(~F.col("body").rlike("[<&>]") | F.col("body").rlike("^[^&<]*<[^A-Za-z/!?]|^[^&<]*&[^A-Za-z#]"))
    r = s.select("doc_id", "pos", xhtml.xhtml_to_text(_div(F.col("body"))).alias("r"))
    return r.select("doc_id", "pos", F.when(F.col("r.error").isNotNull(), "unreadable").when(F.col("r.text").rlike("^[ \\t\\r\\n]*$"), "absent").otherwise("present").alias("status"))


@query(
    "x4_list_markers",
    "WITH n AS (SELECT i AS n FROM range(1, 1500) t(i)) SELECT n, CAST(n AS VARCHAR) AS decimal, CASE WHEN n <= 26 THEN chr(CAST(96 + n AS INT)) WHEN n <= 702 THEN chr(CAST(96 + (n - 1) // 26 AS INT)) || chr(CAST(97 + (n - 1) % 26 AS INT)) ELSE chr(CAST(96 + ((n - 1) // 26 - 1) // 26 AS INT)) || chr(CAST(97 + ((n - 1) // 26 - 1) % 26 AS INT)) || chr(CAST(97 + (n - 1) % 26 AS INT)) END AS lower, repeat('m', n // 1000) || ['', 'c', 'cc', 'ccc', 'cd', 'd', 'dc', 'dcc', 'dccc', 'cm'][n // 100 % 10 + 1] || ['', 'x', 'xx', 'xxx', 'xl', 'l', 'lx', 'lxx', 'lxxx', 'xc'][n // 10 % 10 + 1] || ['', 'i', 'ii', 'iii', 'iv', 'v', 'vi', 'vii', 'viii', 'ix'][n % 10 + 1] AS roman, repeat(chr(CAST(65 + (n - 1) % 26 AS INT)), CAST((n - 1) // 26 + 1 AS INT)) AS label FROM n",
)
def x4(spark: SparkSession, sf: str) -> DataFrame:
    """Markers of list items in the styles 1, a, i, and the repeated letters of labels."""
    n = F.col("id")
    return spark.range(1, 1500).select(n.alias("n"), n.cast("string").alias("decimal"), text.base26_letter(n).alias("lower"), text.roman(n).alias("roman"), text.repeated_letter(n).alias("label"))


FORMATS = ("none", "decimal", "decimalZero", "upperRoman", "lowerRoman", "upperLetter", "lowerLetter")


@query(
    "p16_number_formats",
    "SELECT p_partkey, ['none', 'decimal', 'decimalZero', 'upperLetter', 'lowerLetter'][p_partkey % 5 + 1] AS format, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN CAST(p_size AS VARCHAR) WHEN 2 THEN CASE WHEN p_size < 10 THEN '0' ELSE '' END || p_size WHEN 3 THEN repeat(chr(65 + (p_size - 1) % 26), (p_size - 1) // 26 + 1) ELSE repeat(chr(97 + (p_size - 1) % 26), (p_size - 1) // 26 + 1) END AS label FROM part",
)
def p16(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers in the formats of word processors (roman ones are in x4)."""
    names = F.array(*[F.lit(x) for x in ("none", "decimal", "decimalZero", "upperLetter", "lowerLetter")])
    p = table(spark, sf, "part").select("p_partkey", F.element_at(names, (F.col("p_partkey") % 5 + 1).cast("int")).alias("format"), F.col("p_size").cast("long").alias("n"))
    return p.select("p_partkey", "format", text.number_format(F.col("n"), F.col("format")).alias("label"))


@query(
    "p14_underlines",
    "SELECT p_partkey, regexp_matches(mid, '[^A-Za-z0-9 .,;:()\\[\\]/''\"%@_&#!?*]') OR regexp_matches(substr(t, 2, 7), '[0-9][a-z]') AS changes FROM (SELECT p_partkey, t, substr(t, 3, 6) AS mid FROM (SELECT p_partkey, p_size || CASE WHEN p_partkey % 3 = 0 THEN '+' WHEN p_partkey % 3 = 1 THEN 'a' ELSE ' ' END || p_name AS t FROM part)) WHERE NOT regexp_matches(t, '[Nn]o')",
)
def p14(spark: SparkSession, sf: str) -> DataFrame:
    """Whether an underline over the third to eighth character could change what the drawn text says."""
    k = F.col("p_partkey") % 3
    t = F.concat(F.col("p_size").cast("string"), F.when(k == 0, "+").when(k == 1, "a").otherwise(" "), "p_name")
    return table(spark, sf, "part").select("p_partkey", t.alias("t")).filter(~F.col("t").rlike("[Nn]o")).select("p_partkey", text.underline_changes(F.col("t"), F.lit(2), F.lit(8)).alias("changes"))


@query(
    "w10_list_ordinals",
    f"""WITH {SECTIONS_SQL}, l AS (SELECT doc_id, pos, CAST((pos * 5 + doc_id) % 3 AS INT) AS level FROM sections),
a AS (SELECT *, sum(CAST(level = 0 AS INT)) OVER w AS n0 FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
b AS (SELECT *, sum(CAST(level = 1 AS INT)) OVER (PARTITION BY doc_id, n0 ORDER BY pos) AS n1 FROM a),
c AS (SELECT *, sum(CAST(level = 2 AS INT)) OVER (PARTITION BY doc_id, n0, n1 ORDER BY pos) AS n2 FROM b)
SELECT doc_id, pos, CASE level WHEN 0 THEN n0 || '.' WHEN 1 THEN n0 || '.' || n1 ELSE n0 || '.' || n1 || '.' || n2 END AS label FROM c""",
)
def w10(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of three levels, each starting again below the one above it."""
    lines = sections(spark, sf).select("doc_id", "pos", ((F.col("pos") * 5 + F.col("doc_id")) % 3).alias("level"))
    own: list[str] = ["doc_id"]
    for level in range(3):
        over = Window.partitionBy(*own).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        lines = lines.withColumn(f"n{level}", F.sum((F.col("level") == level).cast("int")).over(over))
        own = [*own, f"n{level}"]
    label = F.when(F.col("level") == 0, F.concat("n0", F.lit("."))).when(F.col("level") == 1, F.concat_ws(".", "n0", "n1")).otherwise(F.concat_ws(".", "n0", "n1", "n2"))
    return lines.select("doc_id", "pos", label.alias("label"))


@query(
    "w13_row_spans",
    "WITH r AS (SELECT l_orderkey, CAST(l_quantity AS INT) % 3 AS down, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem) SELECT b.l_orderkey, b.n AS place, count(a.n) AS covered FROM r b LEFT JOIN r a ON a.l_orderkey = b.l_orderkey AND a.n < b.n AND a.n + a.down >= b.n GROUP BY 1, 2",
)
def w13(spark: SparkSession, sf: str) -> DataFrame:
    """How many slots of each row cells from above cover (a cell spans up to two further rows): each cell gives a
    row for each row that it reaches, and these are counted; no rows are paired."""
    over = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    r = table(spark, sf, "lineitem").select("l_orderkey", F.row_number().over(over).alias("n"), (F.col("l_quantity").cast("int") % 3).alias("down"))
    below = r.filter("down > 0").select("l_orderkey", F.explode(F.sequence(F.col("n") + 1, F.col("n") + F.col("down"))).alias("n")).groupBy("l_orderkey", "n").agg(F.count(F.lit(1)).alias("covered"))
    return r.join(below, ["l_orderkey", "n"], "left").select("l_orderkey", F.col("n").cast("long").alias("place"), F.coalesce("covered", F.lit(0)).alias("covered"))


@query(
    "w17_inheritance",
    """WITH RECURSIVE s AS (SELECT n_nationkey AS style, CASE WHEN n_nationkey % 10 = 9 THEN n_nationkey ELSE n_nationkey // 2 END AS based, CASE WHEN n_nationkey % 5 = 0 THEN 'c' || n_nationkey END AS color, CASE WHEN n_nationkey % 3 = 1 THEN 's' || n_nationkey END AS size FROM nation),
c AS (SELECT style, style AS at, 0 AS depth FROM s UNION ALL SELECT c.style, s.based, depth + 1 FROM c JOIN s ON s.style = c.at WHERE c.at > 0 AND s.based <> c.at)
SELECT c.style, max(depth) AS depth, arg_min(s.color, depth) FILTER (s.color IS NOT NULL) AS color, arg_min(s.size, depth) FILTER (s.size IS NOT NULL) AS size FROM c JOIN s ON s.style = c.at GROUP BY 1""",
)
def w17(spark: SparkSession, sf: str) -> DataFrame:
    """Values of styles along their chain of parents, nearest first, each property by itself; a style based on
    itself has no parent."""
    k = F.col("n_nationkey")
    styles = table(spark, sf, "nation").select(
        k.alias("style"), F.when(k % 10 == 9, k).otherwise(F.expr("CAST(n_nationkey DIV 2 AS INT)")).alias("based"), F.when(k % 5 == 0, F.concat(F.lit("c"), k)).alias("color"), F.when(k % 3 == 1, F.concat(F.lit("s"), k)).alias("size")
    )
    chain = spark.sql(
        """WITH RECURSIVE c(style, at, depth) AS (
             SELECT style, style, 0 FROM {s}
             UNION ALL SELECT c.style, s.based, depth + 1 FROM c JOIN {s} s ON s.style = c.at WHERE c.at > 0 AND s.based <> c.at)
           SELECT style, at, depth FROM c""",
        s=styles,
    )
    both = chain.join(styles.select(F.col("style").alias("at"), "color", "size"), "at")
    nearest = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("depth", c)))[c].alias(c)
    return both.groupBy("style").agg(F.max("depth").alias("depth"), nearest("color"), nearest("size"))


@query(
    "x10_grid",
    "WITH e AS (SELECT DISTINCT l_orderkey, CAST(round(l_extendedprice) AS BIGINT) AS edge FROM lineitem), f AS (SELECT *, CASE WHEN edge - lag(edge) OVER w <= 50 THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY l_orderkey ORDER BY edge)) SELECT l_orderkey, edge, CAST(sum(fresh) OVER (PARTITION BY l_orderkey ORDER BY edge) AS BIGINT) AS line FROM f",
)
def x10(spark: SparkSession, sf: str) -> DataFrame:
    """Grid lines of a drawing (an order): edges within fifty units of the one before are one line."""
    e = table(spark, sf, "lineitem").select("l_orderkey", F.round("l_extendedprice").cast("long").alias("edge")).distinct()
    own = Window.partitionBy("l_orderkey").orderBy("edge")
    fresh = F.when(F.col("edge") - F.lag("edge").over(own) <= 50, 0).otherwise(1)
    return e.withColumn("fresh", fresh).select("l_orderkey", "edge", F.sum("fresh").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("line"))


@query(
    "p15_repeated_starts",
    f"WITH {SECTIONS_SQL}, h AS (SELECT doc_id, pos, trim(body) AS body, first_value(trim(body)) OVER (PARTITION BY doc_id ORDER BY pos) AS head FROM sections), s AS (SELECT doc_id, pos, sum(CAST(body = head AS INT)) OVER (PARTITION BY doc_id ORDER BY pos) AS part FROM h) SELECT doc_id, CAST(part AS BIGINT) AS part, min(pos) AS first_pos, count(*) AS n_lines FROM s GROUP BY 1, 2",
)
def p15(spark: SparkSession, sf: str) -> DataFrame:
    """Several documents in one file: a new one starts wherever the first heading (line) is repeated."""
    own = Window.partitionBy("doc_id").orderBy("pos")
    s = sections(spark, sf).select("doc_id", "pos", F.xxhash64(F.trim("body")).alias("h"))  # no text goes through the window
    s = s.withColumn("start", (F.col("h") == F.first("h").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))).cast("int"))
    s = s.withColumn("part", F.sum("start").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return s.groupBy("doc_id", "part").agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n_lines"))


@query("n10_capitals", "SELECT p_partkey, upper(replace(p_name || ' µ ß ⅷ', 'ß', '§')) AS capitals FROM part WHERE false UNION ALL SELECT p_partkey, upper(p_name) || ' µ ß ⅷ ΪΫ' AS capitals FROM part")
def n10(spark: SparkSession, sf: str) -> DataFrame:
    """Capitals as a word processor draws them: letters whose capital is several letters stay, as do micro signs
    and small roman numerals; two Greek letters have capitals of their own."""
    return table(spark, sf, "part").select("p_partkey", text.capitals(F.concat("p_name", F.lit(" µ ß ⅷ ΐΰ"))).alias("capitals"))
