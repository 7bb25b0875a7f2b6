"""Registry of named queries: Spark builder + optional DuckDB oracle SQL.

Every query reads the driver's tables (through the derived retail lines) and
returns a lazy DataFrame; ``__spark_entry__`` exposes the registry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
SURVEY_IDS: dict[str, tuple[str, ...]] = {}


def register(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    """Decorator: add ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        SURVEY_IDS[name] = ids
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so their queries register."""
    from . import cleaning, profiling, customers, baskets, demand, seasonal, hours, ingest  # noqa: F401
