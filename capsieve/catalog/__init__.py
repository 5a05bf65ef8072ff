"""All registered queries. Each reads the sample tables of one folder."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from capsieve.catalog import base

_MODULES = ("universe", "hydration", "events", "runway", "research", "feeds", "stores")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"capsieve.catalog.{name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(base.SQL)
