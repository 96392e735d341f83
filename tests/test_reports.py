"""Templates, resemblance, edits and verification rules on hand-made rows, against plain versions."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from quillstone.functions import quoting, templates
from quillstone.operators import resemblance, search
from quillstone.plans import reports
from quillstone.sources import shapes


@pytest.mark.parametrize(
    "template,yes,no",
    [
        ("Take {dose} of the medicine(s)", ["take 5 mg of the medicines", "Take\n2 of the medicine(s)", "Take x of the medicine"], ["Take of the medicine", "Take " + "x" * 301 + " of the medicine"]),
        ("Store <in a <cool >place >below 25", ["Store below 25", "store in a place below 25", "Store in a cool place below 25"], ["Store in a cool below 25"]),
        ("Stop[if needed] at once", ["Stop at once"], ["Stop if needed at once"]),
    ],
)
def test_templates(template, yes, no):
    p = re.compile(templates.pattern(template))
    a = templates.anchor(template)
    assert all(p.search(t) and a in " ".join(t.split()) for t in yes) and not any(p.search(t) for t in no)


def test_template_marks_must_balance():
    for bad in ("a {b", "a <b", "a > b", "a ] b"):
        with pytest.raises(ValueError):
            templates.parse(bad)


def test_resembling_equals_all_pairs(spark):
    pick = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["the"] * 40
    patterns = [[pick.choice(vocabulary) for _ in range(pick.randint(6, 14))] for _ in range(12)]
    texts = []
    for i in range(80):
        t = [pick.choice(vocabulary) for _ in range(pick.randint(0, 40))]
        if i % 2:
            p = list(pick.choice(patterns))
            if pick.random() < 0.6:
                p[pick.randrange(len(p))] = "other"
            at = pick.randint(0, len(t))
            t[at:at] = p
        texts.append(t)
    p = spark.createDataFrame(list(enumerate(patterns)), "item_id long, words array<string>")
    t = spark.createDataFrame(list(enumerate(texts)), "text_id long, words array<string>")
    got = {(r.item_id, r.text_id): r.score for r in resemblance.resembling(p, "item_id", t, ["text_id"]).collect()}
    want = {}
    for i, a in enumerate(patterns):
        for j, b in enumerate(texts):
            s = quoting.align(a, b, True)
            if s >= 0.85 and len(a) * s >= min(6, len(a)) * 0.85:
                want[i, j] = s
    assert got == pytest.approx(want) and len(want) > 20


def test_alignment_anywhere():
    assert quoting.align("b c d".split(), "x a b c d e".split(), True) == 1
    assert quoting.align("b c d f".split(), "x b c d e".split(), True) == pytest.approx(3 / 4)
    assert quoting.align(["a"], [], True) == 0


def test_phrases_equal_a_plain_search(spark):
    pick = random.Random(3)
    texts = [" ".join(pick.choice(["a", "b", "(c", "c)", "d.", "e"]) for _ in range(pick.randint(0, 30))) for _ in range(60)]
    phrases = ["a", "c", "a b", "b c d", "e e", "c) d", "a b c d e"]
    t = spark.createDataFrame(list(enumerate(texts)), "i long, body string")
    p = spark.createDataFrame(list(enumerate(phrases)), "p long, phrase string")
    got = {(r.i, r.p, r.start, r.end) for r in search.located(t, ["i"], "body", p, "p", "phrase").collect()}
    assert got == {(i, j, *quoting.find(x, q)) for i, x in enumerate(texts) for j, q in enumerate(phrases) if quoting.find(x, q)}


def test_wordings_grow_until_unique():
    words = "x a b c d e y a b c d e z".split()
    old, new = quoting.wording(words, 3, "N")
    assert len(quoting.occurrences(" ".join(words), old)) == 1 and new == old.replace("c", "N")
    assert quoting.occurrences("aaaa", "aa") == [0, 1, 2] and quoting.occurrences("x", "") == []


def test_paragraph_changes_add_up(spark, sf):
    assert quoting.paragraph_changes(list("abcd"), list("axcde")) == {"kept": 3, "changed": 1, "inserted": 1, "deleted": 0}
    d = spark.read.parquet(f"{sf}/documents.parquet").filter("text IS NOT NULL")
    for r in d.select("text", reports.amended(F.col("text")).alias("later")).limit(50).collect():
        a, b = r.text.split("\n"), r.later.split("\n")
        c = quoting.paragraph_changes(a, b)
        assert c["kept"] + c["changed"] + c["deleted"] == len(a) and c["kept"] + c["changed"] + c["inserted"] == len(b)


def test_template_report_by_hand(spark, tmp_path):
    words = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()
    passage = " ".join(words)
    near = passage.replace("iota", "other").replace("gamma ", "")
    turns = [(0, 0, "user", f"so: {passage} and"), (1, 0, "user", passage.replace("gamma", "any\nname")), (2, 0, "user", passage.replace("zeta eta ", "")), (3, 0, "user", near), (4, 0, "user", "nothing"), (5, 0, "user", None)]
    spark.createDataFrame([(7, passage + " omicron")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [tuple(r) for r in reports.t6(spark, str(tmp_path)).collect()] == [(7, 3, 1, 1)]


def test_shapes_of_json():
    assert shapes.shape_of("[" * 49 + "]" * 49) == "too-deep" and shapes.shape_of('["[[[["]') == "fits"
    assert shapes.shape_of('{"a": "\\"[", "b": [1, {}]}') == "fits" and shapes.shape_of("{") == "not-json"
    assert shapes.paths_of({"a": [{"b": 1}, {"c": {"d": 2}}], "e": "a.f"}) == ["a", "a[].b", "a[].c", "a[].c.d", "e"]
