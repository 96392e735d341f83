"""Line deduplication over overlapping windows of three lines [native].

The lines of a text are split at line feeds. Each window of three consecutive lines is hashed to
128 bits; windows are counted over all documents (partial aggregation inside each task, so a
passage of any popularity arrives as one row per task). An occurrence is repeated if the same
window also occurs earlier: in a document with a smaller doc_id, or higher up in the same one. Runs
of repeated windows are merged into covered line ranges, and the lines in them are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, materialize, table, units

WINDOW = 3


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_hashes(text: Column) -> Column:
    """array<struct<a long, b long>>: two 64-bit hashes of each three consecutive lines."""

    def of(lines: Column) -> Column:
        count = F.greatest(F.size(lines) - (WINDOW - 1), F.lit(0))
        rows = F.slice(F.arrays_zip(lines.alias("p"), F.slice(lines, 2, F.size(lines)).alias("q"), F.slice(lines, 3, F.size(lines)).alias("r")), F.lit(1), count)
        return F.transform(rows, lambda x: F.struct(F.xxhash64(x["p"], x["q"], x["r"]).alias("a"), F.xxhash64(F.lit(7), x["r"], x["p"], x["q"]).alias("b")))

    return _let(F.split(text, "\n"), of)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """doc_id, pos: the windows that also occur earlier (pos counts from 0)."""
    spread = docs.select(F.col("doc_id"), F.posexplode(window_hashes(F.col("text"))).alias("pos", "w")).select("doc_id", "pos", "w.a", "w.b")
    every = materialize(spread, "line-windows")
    seen = every.groupBy("a", "b").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = every.join(seen.select("a", "b", "first"), ["a", "b"]).filter(~F.struct("doc_id", "pos").eqNullSafe(F.col("first")))
    found = materialize(again.select("doc_id", "pos").distinct(), "line-repeats")
    forget(every)
    return found


def covered_ranges(repeats: DataFrame) -> DataFrame:
    """doc_id, cut array<struct<s, e>>: merged line ranges [s, e), sorted."""
    order = Window.partitionBy("doc_id").orderBy("pos")
    apart = F.coalesce(F.col("pos") > F.lag("pos").over(order) + WINDOW, F.lit(True))
    runs = repeats.withColumn("run", F.sum(apart.cast("int")).over(order))
    merged = runs.groupBy("doc_id", "run").agg(F.min("pos").alias("s"), (F.max("pos") + WINDOW).alias("e"))
    return merged.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("cut"))


def _kept_text(text: Column, cut: Column) -> Column:
    """The lines outside the ranges, joined again."""

    def of(lines: Column) -> Column:
        gaps = F.transform(
            F.sequence(F.lit(0), F.size(cut)),
            lambda i: F.struct(
                F.when(i == 0, F.lit(0)).otherwise(F.get(cut, i - 1)["e"]).alias("s"),
                F.when(i == F.size(cut), F.size(lines)).otherwise(F.get(cut, i)["s"]).alias("e"),
            ),
        )
        return F.array_join(F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["s"] + 1, F.greatest(g["e"] - g["s"], F.lit(0))))), "\n")

    return _let(F.split(text, "\n"), of)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with the repeated lines taken out of text, and _removed_lines (the line ranges removed, null if none).

    Null texts stay null; texts of fewer than three lines stay as they are; a text whose lines all
    go becomes empty. Every row is a document of its own: rows without a doc_id come before all
    others, and rows of one doc_id (or of none) are ordered by hashes of their texts. Other columns
    pass through.
    """
    rows, unit = units(docs)
    repeats = repeated_windows(rows.select(F.col(unit).alias("doc_id"), "text"))
    cut = covered_ranges(repeats).select(F.col("doc_id").alias("cut_id"), F.col("cut").alias("cut_lines"))
    # A merge join at any size: the plan, and what it shuffles, must not depend on how few ranges there are.
    joined = rows.join(cut.hint("merge"), rows[unit] == cut["cut_id"], "left")
    new = F.when(cut["cut_lines"].isNull(), rows["text"]).otherwise(_kept_text(rows["text"], cut["cut_lines"]))
    return joined.select(*[new.alias(c) if c.lower() == "text" else rows[c] for c in docs.columns], cut["cut_lines"].alias("_removed_lines"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    removed = F.coalesce(F.aggregate("_removed_lines", F.lit(0), lambda n, x: n + x["e"] - x["s"]), F.lit(0))
    return dedup_lines(docs).select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
        F.coalesce(F.size("_removed_lines"), F.lit(0)).cast("long").alias("n_ranges"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL),
w AS (
  SELECT doc_id, pos, line, lead(line, 1) OVER d AS l2, lead(line, 2) OVER d AS l3
  FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
rep AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, pos) > 1 AS again FROM w WHERE l3 IS NOT NULL),
marked AS (
  SELECT l.doc_id, l.pos, l.line,
    coalesce(max(CAST(r.again AS INT)) OVER (PARTITION BY l.doc_id ORDER BY l.pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM lines l LEFT JOIN rep r ON l.doc_id = r.doc_id AND l.pos = r.pos),
runs AS (
  SELECT *, CASE WHEN gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), 0) = 0 THEN 1 ELSE 0 END AS starts FROM marked),
per AS (
  SELECT doc_id, count(*) AS n_lines, sum(gone) AS n_removed, sum(starts) AS n_ranges,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (gone = 0), '') AS kept
  FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_ranges, 0) AS BIGINT) AS n_ranges, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per ON d.doc_id = per.doc_id
"""
