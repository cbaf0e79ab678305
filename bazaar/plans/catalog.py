"""The full query catalogue: ``queries()`` and ``oracle_sql()``."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaar.plans.registry import REGISTRY, Query

_LOADED = False


def _load() -> dict[str, Query]:
    global _LOADED
    if not _LOADED:
        # importing registers the queries
        from bazaar.plans import report_queries, clean_queries, model_queries, sink_queries  # noqa: F401
        _LOADED = True
    return REGISTRY


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.spark for name, q in _load().items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql() for name, q in _load().items() if q.oracle is not None}
