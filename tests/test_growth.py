"""Work in proportion to the input, and the cases that the forms which grow so must not lose."""

from __future__ import annotations

import random
import re

import pandas as pd
from pyspark.sql import functions as F

from quillstone import plans
from quillstone.functions import text
from quillstone.shipping import slices
from quillstone.operators import verification
from quillstone.plans.verification import submission

from .oracle import assert_equal


def test_word_cuts_beyond_the_pieces(spark):
    """Runs of gaps and white space longer than a piece: what stands before and behind them decides."""
    texts = ["a­" + " " * 40 + "b", "12" + " " * 35 + "34", "12" + " " * 20 + "\n" + " " * 20 + "34", " " * 50, "7\n8", "x", "­\n9 9", "1" * 30, "ab cd " * 9, "5" + "​" * 21 + "\n" + "6", "é𝟗 𝟗" * 12]
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    at = rows.filter(F.length("t") > 1).select("k", "t", F.explode(F.sequence(F.lit(1), F.length("t") - 1, F.lit(5))).alias("place"))
    want = at.select("k", "place", verification.starts_inside(F.substring("t", F.lit(1), F.col("place")), F.substring("t", F.col("place") + 1, F.length("t"))).alias("starts_inside"))
    got = verification.inside_each(rows, "k", "t", 5)
    edge, gaps = verification.EDGE, verification.GAPS
    for r in got.collect():
        before, inner = texts[r.k][: r.place], texts[r.k][r.place :]
        number = re.search(f"\\d[{gaps}]*\\Z", before.split("\n")[-1]) and re.match(f"[{gaps}]*\\d", inner)
        assert r.starts_inside == bool(re.search(f"[^{edge}]\\Z", before) or re.search(f"\\u00ad[{edge}]+\\Z", before) or number), r
    assert sorted(got.collect()) == sorted(want.collect()) and any(r.starts_inside for r in got.collect())


def test_word_cuts_of_a_long_text(spark, tmp_path):
    """A text of a million letters: looking back to its start from every place took minutes."""
    spark.createDataFrame([(1, "word 12 " * 130_000)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = plans.QUERIES["q5_word_cuts"](spark, str(tmp_path))
    assert rows.count() == len(range(1, 8 * 130_000, 97))


def test_first_holder_of_equal_lines(spark, sf, tmp_path):
    """Equal order and line numbers (the first of the file holds), no holder, no order number."""
    for name, rows, kind in (
        ("part", [(k,) for k in range(1, 6)], "p_partkey long"),
        ("supplier", [(k, f"S{k}", k % 25) for k in range(1, 10)], "s_suppkey long, s_name string, s_nationkey int"),
        ("lineitem", [(1, 9, 4, 1), (1, 2, 4, 1), (1, 5, 4, 1), (2, 3, 8, 2), (2, 4, 8, 1), (3, None, 1, 1), (3, 7, 2, 1), (4, 3, None, 1), (4, 6, 7, 1)], "l_partkey long, l_suppkey long, l_orderkey long, l_linenumber int"),
    ):
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/made/{name}")
        part = next(p for p in (tmp_path / "made" / name).iterdir() if p.suffix == ".parquet")
        part.rename(tmp_path / f"{name}.parquet")
    (tmp_path / "nation.parquet").symlink_to(f"{sf}/nation.parquet")
    df = plans.QUERIES["j7_first_holder"](spark, str(tmp_path))
    assert {r.p_partkey: r.holder for r in df.collect()} == {1: "S9", 2: "S4", 3: "S7", 4: "S6", 5: None}
    assert assert_equal(df, plans.ORACLE_SQL["j7_first_holder"], str(tmp_path)) == 5


def test_ordinary_text_is_collapsed_like_any_other(spark):
    """Ordinary text takes a short way to the same result."""
    draw = random.Random(7)
    made = ["".join(draw.choices("ab \t\n\r\xa0é", k=draw.randrange(12))) for _ in range(400)]
    c = F.col("t")
    rows = spark.createDataFrame([(t,) for t in made + ["a\u2003b", "•", "é\u0301", "\x01"]], "t string")
    got = rows.select("t", text.ordinary(c).alias("o"), text.normalize(c).alias("n"), text.collapse(c).alias("w")).collect()
    assert [r.o for r in got] == [True] * 400 + [False] * 4
    assert all(r.n == r.w == re.sub("[ \t\n\r\xa0]+", " ", r.t).strip(" ") for r in got[:400])
    assert [r.n for r in got[400:]] == ["a b", "•", "é\u0301", None]


def test_conservation_counts_only_what_differs(spark, tmp_path):
    """Empty texts, words that move between a line's sides, and no shuffle of lines that are read as they stand."""
    texts = {2: "a b\nb  c\nextra", 4: "a a\na b a\nb", 6: " \n ", 8: "", 10: None, 14: " \n ", 16: "x", 20: "\n", 1: "p q " * 20000}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/made")
    next(p for p in (tmp_path / "made").iterdir() if p.suffix == ".parquet").rename(tmp_path / "documents.parquet")
    df = plans.QUERIES["p18_conservation"](spark, str(tmp_path))
    assert assert_equal(df, plans.ORACLE_SQL["p18_conservation"], str(tmp_path)) == 6
    assert "FullOuter" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_page_texts_stay_out_of_the_windows(spark, sf):
    """A page's text used to be carried along, twice, by every span of it."""
    _, spans, pages = submission(spark, sf)
    plan = verification.resolve_spans(spans, pages)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Window")]
    assert windows and not any("page_text" in line for line in windows)
    assert verification.resolve_spans(spans, pages).count() == spans.count()


def test_batches_are_met_in_slices(spark):
    """A column function never holds what it makes of a whole batch of texts: no slice is above the bound, but rows that are."""
    texts, numbers = pd.Series(["ab", None, "c" * 9, "", "d" * 30, "e"] * 50), pd.Series(range(300))
    got = list(slices([(texts, numbers), (texts[:0], numbers[:0])], 10))
    assert [v for t, n in got for v in zip(t, n)] == list(zip(texts, numbers)) and len(got) > 150
    assert all(len(t) == len(n) and (sum(len(x or "") for x in t) <= 10 or sum(bool(x) for x in t) == 1) for t, n in got)
    assert [list(s) for s in slices([texts[:2]], 10)] == [["ab", None]]
    rows = spark.range(0, 300, 1, 1).select("id", F.repeat(F.lit("a\u0301"), 20_000).alias("t"))
    assert rows.filter(F.length(text.nfc(F.col("t"))) != 20_000).count() == 0
