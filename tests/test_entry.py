"""The driver contract."""

from __future__ import annotations

import __spark_entry__ as e


def test_contract(spark):
    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.count() > 0 and "outcome" in df.columns


def test_verify_quote_keeps_to_the_edge_rule(spark, tmp_path):
    docs = [(1, "Take 2.5 mg. Take 2 daily."), (2, "Take 2.5 mg"), (3, "at -20 °C"), (4, "so\nTake 2"), (5, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "Take  2"), (2, "20 °C"), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.item_id: (r.outcome, r.doc_id, r.span_start, r.span_end, r.n_documents) for r in e.queries()["verify_quote"](spark, str(tmp_path)).collect()}
    assert got == {1: ("match", 1, 13, 19, 2), 2: ("no-match", None, None, None, 0), 3: ("invalid-request", None, None, None, 0)}
