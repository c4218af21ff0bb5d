"""Registry of named queries: Spark builder + DuckDB oracle SQL (optional)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: ``@register("name", sql)`` adds a query and its oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


MODULES = ("q_clean", "q_profile", "q_quality", "q_features", "q_split", "q_metrics",
           "q_drift", "q_scoring", "q_model", "q_stream", "q_monitor", "q_sources", "q_service")


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for m in MODULES:
        try:
            importlib.import_module(f"clickscope.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"clickscope.plans.{m}":
                raise
