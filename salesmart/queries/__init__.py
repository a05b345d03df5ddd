"""The registered queries: each operator over the test tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its rows are checked."""

    def register(run: Run) -> Run:
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
