"""Query name to builder, and query name to oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a builder under ``name``; without SQL the query is checked by rows only."""

    def add(fn):
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(c: Column | str, name: str) -> Column:
    """Six decimals, without a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.round(c.cast("double"), 6) + F.lit(0.0)).alias(name)


def s6(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0 AS {name}"
