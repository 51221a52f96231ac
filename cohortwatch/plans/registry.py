"""Registry of query keys: Spark callables and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with optional oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def with_ctes(body: str, **ctes: str) -> str:
    """``WITH a AS (...), b AS (...) body``."""
    if not ctes:
        return body
    parts = ",\n".join(f"{k} AS ({v})" for k, v in ctes.items())
    return f"WITH {parts}\n{body}"
