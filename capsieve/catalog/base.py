"""Registry of the queries and of the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from capsieve.plans.standins import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, *views: str, sql: str | None = None) -> Callable:
    """Register ``fn(tables)`` under a name, with its SQL twin over the stand-in views."""
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = with_views(sql, *views)
        return fn

    return register
