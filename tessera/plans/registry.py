"""Registry of check queries: key -> Spark callable, key -> DuckDB oracle SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_MODULES = ("q_sources", "q_storage", "q_partitions", "q_ledger", "q_monitor",
            "q_freshness", "q_flows", "q_streams")


def register(key: str, sql: str | None = None):
    """Register a check query; ``sql`` None means rows-only (no oracle)."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"tessera.plans.{m}")
        except ModuleNotFoundError as e:  # modules still being written
            if e.name != f"tessera.plans.{m}":
                raise
