"""Registry of named queries over the test tables, each with an optional oracle SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, (fn.__doc__ or "").strip())
        return fn
    return deco


# -- small SQL text helpers for the oracle (DuckDB dialect) -------------------------------

def bucket_us(col: str, micros: int) -> str:
    """Start of the epoch-aligned bucket, in microseconds."""
    return f"(epoch_us({col}) // {micros}) * {micros}"


def ts_of(us_expr: str) -> str:
    return f"make_timestamp({us_expr})"
