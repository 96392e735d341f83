"""Queries over the tables of a folder, each with its SQL for DuckDB where SQL expresses it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import aggregates, documents, files, gates, markup, quotes, reports, rules, scalars, scans, services, streams, verification

MODULES = (quotes, verification, gates, reports, markup, services, rules, documents, aggregates, scans, scalars, streams, files)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
for module in MODULES:
    QUERIES |= module.QUERIES
    ORACLE_SQL |= module.ORACLE_SQL
