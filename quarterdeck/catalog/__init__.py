"""Registered queries and, where one exists, the ANSI SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ["panel", "heal", "normalization", "composites", "comparison", "loans", "tracker", "series", "local", "checks", "files", "forecasting"]


def _load():
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}
    for name in MODULES:
        module = import_module(f"quarterdeck.catalog.{name}")
        clash = set(queries) & set(module.QUERIES)
        if clash:
            raise ValueError(f"query names registered twice: {sorted(clash)}")
        queries.update(module.QUERIES)
        oracles.update(module.ORACLES)
    return queries, oracles


def queries() -> dict[str, Query]:
    return _load()[0]


def oracle_sql() -> dict[str, str]:
    return _load()[1]
