"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the given name, or that of its function."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register
