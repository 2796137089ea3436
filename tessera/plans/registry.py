"""The registry of queries: a Spark plan and, where SQL can say it, a DuckDB oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
MODULES: list[str] = ["profiling", "fusing", "featuring", "texts", "ordered", "reports", "catalogue", "evaluating"]


def query(oracle: str | None = None):
    """Register a function under its own name, with its oracle."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if oracle:
            _ORACLES[f.__name__] = oracle
        return f

    return add


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"tessera.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
