"""The pipeline's stages, each on its own input."""

from __future__ import annotations

import corpus_pipeline
from quillstone.llm import chosenpath

from .test_operators import documents, plain_line_dedup


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialize(stage(spark, docs, sf), name)
        assert out.columns == columns
        before, after = [r.doc_id for r in docs.collect()], [r.doc_id for r in out.collect()]
        assert set(after) <= set(before)
        if name == "line_dedup":
            want = {k: v for k, v in plain_line_dedup([(r.doc_id, r.text) for r in docs.collect()]).items()}
            assert all(want[r.doc_id] == r.text for r in out.collect())
        if name == "near_dedup":
            kept = {r.doc_id for r in chosenpath.near_duplicates(docs).filter("kept").collect()}
            assert set(after) == kept
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert last.count() == docs.count()


def test_stages_on_nothing_and_odd_rows(spark, sf):
    odd = documents(spark, [None, "", "123", "the of and " * 30, "x" * 50_000, "a\nb\nc\nd"])
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf).count()


def test_near_dedup_decides_by_row(spark, sf):
    a, b = "one two three four five six seven", "un deux trois quatre cinq six sept"
    docs = spark.createDataFrame([(1, b, "en"), (2, a, "en"), (2, b, "en"), (3, a, "en")], "doc_id long, text string, lang string")
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()) == [(1, b), (2, a)]


def test_language_id_without_labels(spark, sf):
    rows = [(1, "the of and", None), (2, None, None), (3, "123 ?!", None), (4, "", None), (5, "der und die", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted((r.doc_id, r.lang) for r in corpus_pipeline.language_id(spark, docs, sf).collect()) == [(1, "und"), (5, "und")]
