"""Counts that describe a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_nulls(df: DataFrame) -> DataFrame:
    """Filled and missing values per column, from one aggregate."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.col(c)).alias("non_null"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, missing values and distinct values per column."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(t).alias("dtype"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            distinct(F.col(c)).alias("distinct_values"),
        )
        for c, t in df.dtypes
    ]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, null included."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def time_range(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n(df: DataFrame, col: str, n: int, ties: list[str], ascending: bool = False) -> DataFrame:
    """The n largest (or smallest) rows; planned as one top-n per task and a merge, not a full sort."""
    first = F.col(col).asc() if ascending else F.col(col).desc()
    return df.orderBy(first, *ties).limit(n)
