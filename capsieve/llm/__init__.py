"""Operators for preparing training text. Nothing else in the library imports this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from capsieve.llm import queries as _queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_queries.SQL)
