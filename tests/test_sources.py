"""Bundles, Word files, templates, operators and sinks on hand-made rows."""

from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quillstone.functions import templates
from quillstone.operators import joins, spans, windows
from quillstone.sources import bundles, words
from quillstone.streaming import sinks


def test_section_tree_is_flattened_in_document_order(spark):
    composition = {"resourceType": "Composition", "section": [{"title": "a", "section": [{"title": "b"}, {"title": "c", "code": {"coding": [{"code": "x"}]}}]}, {"title": "d", "text": {"div": "<div/>"}}]}
    text = json.dumps({"entry": [{"resource": composition}]})
    df = spark.createDataFrame([("1", 1, text), ("2", 1, '{"a":1,"a":2}'), ("3", 1, None)], "bundle_id string, version_id int, json string")
    got = [(r.path, r.depth, r.parent, r.title, r.code, r.div) for r in bundles.flatten(df).orderBy("pos").collect()]
    assert got == [
        ("section[0]", 0, None, "a", None, None), ("section[0].section[0]", 1, "section[0]", "b", None, None),
        ("section[0].section[1]", 1, "section[0]", "c", "x", None), ("section[1]", 0, None, "d", None, "<div/>"),
    ]


def test_tracked_changes_have_two_views():
    markup = f'<w:document xmlns:w="{words.W[1:-1]}"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>a</w:t></w:r><w:ins><w:r><w:t>b</w:t></w:r></w:ins><w:del><w:r><w:delText>c</w:delText></w:r></w:del></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t><w:tab/></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'
    stream = io.BytesIO()
    with zipfile.ZipFile(stream, "w") as z:
        z.writestr("word/document.xml", markup)
    got = words.read_document(stream.getvalue())
    assert [(p["style"], p["row"], p["accepted"], p["rejected"]) for p in got] == [("Heading1", None, "ab", "ac"), (None, 0, "x\t", "x\t")]


def test_files_that_are_no_word_files_are_refused(spark):
    df = spark.createDataFrame([(bytearray(b"nope"),), (None,)], "content binary")
    assert [r.p for r in df.select(words.paragraphs(F.col("content")).alias("p")).collect()] == [None, None]


def test_word_folder(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(words.write_document(["one", "two <&>"]))
    (tmp_path / "b.txt").write_text("x")
    rows = words.read_folder(spark, str(tmp_path)).collect()
    assert [[p.accepted for p in r.paragraphs] for r in rows] == [["one", "two <&>"]]


def test_templates():
    t = "take {dose} <daily> [see note]"
    assert [k for k, _ in templates.parse(t)] == ["text", "fill", "text", "optional", "text", "guidance"]
    assert templates.forms("A <b> c") == ["A b c", "A c"]
    import re

    assert re.search(templates.pattern("the {x} of"), "the big  of")
    with pytest.raises(ValueError):
        templates.parse("a {b")


def test_latest_ties_and_undated(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 0, None), ("b", 9, None)], "k string, id int, at int")
    assert {(r.k, r.id) for r in windows.latest(df, ["k"], "at", "id").collect()} == {("a", 1), ("b", 9)}


def test_chain_finds_forged_links(spark):
    df = spark.createDataFrame([("k", 0, "a", None), ("k", 1, "b", "a"), ("k", 2, "c", "x"), ("k", 4, "d", "c")], "k string, n int, sha string, prev string")
    assert [r.linked for r in windows.chain(df, "k", "n", "sha", "prev").orderBy("n").collect()] == [True, True, False, False]


def test_overlap_of_neighbours_only(spark):
    df = spark.createDataFrame([("p", 1, 0, 10), ("p", 2, 8, 12), ("p", 2, 11, 13), ("p", 3, 13, 14)], "page string, owner int, s int, e int")
    assert [(r.owner, r.before_owner) for r in spans.neighbours_overlap(df, ["page"], "owner").collect()] == [(2, 1)]


def test_matches_are_counted(spark):
    rules = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "key string, required boolean")
    rows = spark.createDataFrame([("b",), ("b",), ("z",)], "key string")
    assert {r.key: r.state for r in joins.matched(rules, rows, "key", F.col("required")).collect()} == {"a": "missing", "b": "ambiguous", "c": "absent"}


def test_versions_are_never_changed_in_place(spark):
    now = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "id string, version int, body string")
    writes = spark.createDataFrame([("a", 2, "n"), ("b", None, "n"), ("c", 5, "n")], "id string, expected int, body string")
    accepted, conflicts = sinks.commit_versions(now, writes)
    assert {(r.id, r.version) for r in accepted.collect()} == {("a", 3), ("b", 1)}
    assert [r.id for r in conflicts.collect()] == ["c"]


def test_a_run_is_written_once(spark, tmp_path):
    df = spark.range(3)
    assert sinks.write_once(df, str(tmp_path / "run")) and not sinks.write_once(df, str(tmp_path / "run"))
    assert sinks.append_new(df.unionByName(df), str(tmp_path / "table"), "id") == 3
    assert sinks.append_new(spark.range(5), str(tmp_path / "table"), "id") == 2
