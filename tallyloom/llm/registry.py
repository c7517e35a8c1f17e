"""Queries of this subpackage by name, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query function under its name, and the SQL it is checked against."""

    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return put
