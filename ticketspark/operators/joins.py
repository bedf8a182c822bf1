"""Joins that stay safe when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SALTS = 16

# rows of a key table that may be broadcast; key tables are a few narrow columns, so some tens of megabytes
BROADCAST_ROWS = 200_000


def attach(df: DataFrame, per_key: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a small table of keys to a table with many rows per key. Runs the job that builds the key table.

    The key table is written once and counted. Up to ``BROADCAST_ROWS`` rows it is broadcast, and the
    large side is not moved at all. Above that the join is salted.
    """
    table = materialize(per_key, "per-key")
    if table.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(table), on, how)
    return salted_join(df, table, on, how)


def salted_join(df: DataFrame, per_key: DataFrame, on: list[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """Equi-join that spreads the rows of a hot key over ``salts`` tasks.

    The salt is a hash of the row itself, so a task that runs again sends each row to the same place.
    """
    left = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    right = per_key.withColumn("_salt", F.explode(every))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle to the configured number of partitions, for rows that are about to grow.

    Adaptive execution merges partitions by their size before the growth; a given number is kept. The
    hash makes this a partitioning of its own, which the planner does not fold into an earlier one.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*keys))


def left_join(a: DataFrame, b: DataFrame, on: list[str], fill: float | None = None) -> DataFrame:
    """Left equi-join; ``fill`` replaces nulls in the numeric columns that ``b`` brings."""
    out = a.join(b, on, "left")
    if fill is None:
        return out
    added = [c for c in b.columns if c not in on]
    return out.fillna(fill, subset=added)


def semi_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is listed in ``keys``."""
    return df.join(keys.select(*on), on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not listed in ``keys``."""
    return df.join(keys.select(*on), on, "left_anti")


def align_to_dates(dates: DataFrame, df: DataFrame, on: list[str], fill: float | None = None) -> DataFrame:
    """Rows of ``df`` on a given date list, null (or ``fill``) where a date has none."""
    return left_join(dates, df, on, fill)


def align_series(
    long: DataFrame, names: list[str], name: str = "series", date: str = "date", value: str = "value", complete: bool = False
) -> DataFrame:
    """Full outer alignment of several series on the date: one aggregate in place of chained joins."""
    cols = [F.max(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names]
    out = long.where(F.col(name).isin(names)).groupBy(date).agg(*cols)
    return out.dropna(subset=names) if complete else out
