"""Runs SQL on the same tables with DuckDB and compares whole results."""

from __future__ import annotations

import glob
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def expected(sql: str, sf: str):
    c = duckdb.connect()
    for t in TABLES:
        if glob.glob(f"{sf}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c.sql(sql)


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(canonical, value)) + "]"
    if hasattr(value, "asDict"):
        return canonical(value.asDict())
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{canonical(v)}" for k, v in sorted(value.items())) + "}"
    return str(value)


def rows(names, values) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(v[i]) for i in order) for v in values)


def assert_equal(df, sql: str, sf: str) -> int:
    want = expected(sql, sf)
    assert sorted(df.columns) == sorted(want.columns)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows(want.columns, want.fetchall())
    return len(got)
