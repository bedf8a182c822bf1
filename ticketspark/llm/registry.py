"""Query name to builder, and query name to oracle SQL, of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def without(df: DataFrame, added: Iterable[str], needed: Iterable[str] = ()) -> DataFrame:
    """``df`` without columns named as those an operator adds (names ignore case), but for those it needs."""
    names = {a.lower() for a in added} - {n.lower() for n in needed}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
