"""All named queries over the reference tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its SQL text."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add
