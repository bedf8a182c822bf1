"""Event tables to count tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar
from .joins import attach
from .ordering import dense_ids

OTHER = "OTHER"


def daily_counts(df: DataFrame, ts: str, by: Sequence[str] = (), out: str = "num_violations") -> DataFrame:
    return df.groupBy(*by, F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias(out))


def weekly_counts(df: DataFrame, ts: str, by: Sequence[str] = (), out: str = "num_violations") -> DataFrame:
    """Events per Monday week with the year, month, ISO week and holiday flag of its first day."""
    weeks = df.groupBy(*by, calendar.week_start(F.col(ts)).alias("week")).agg(F.count(F.lit(1)).alias(out))
    return weeks.withColumns(
        {
            "year": F.year("week"),
            "month": F.month("week"),
            "week_of_year": F.weekofyear("week"),
            "is_holiday_week": calendar.is_holiday_week(F.col("week")),
        }
    )


def counts_by(df: DataFrame, part: dict, out: str = "n") -> DataFrame:
    """Rows per value of named column expressions."""
    return df.groupBy(*[c.alias(n) for n, c in part.items()]).agg(F.count(F.lit(1)).alias(out))


def pivot_counts(
    df: DataFrame, by: Sequence, col: str, values: Sequence[str], prefix: str = "", total: str | None = None
) -> DataFrame:
    """One count column per listed value: conditional counts in one aggregate, so one shuffle."""
    counts = [F.count_if(F.col(col) == v).alias(f"{prefix}{v}") for v in values]
    if total:
        counts = [F.count(F.lit(1)).alias(total), *counts]
    return df.groupBy(*by).agg(*counts)


def top_values(df: DataFrame, col: str, k: int, unknown: str | None = "UNKNOWN") -> DataFrame:
    """The k most frequent values as text; a tie goes to the smaller value.

    ``unknown`` names the bucket of nulls; None leaves nulls out.
    """
    key = F.col(col).cast("string")
    key = F.coalesce(key, F.lit(unknown)) if unknown else key
    counts = df.groupBy(key.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("value").isNotNull()).orderBy(F.desc("n"), "value").limit(k)


def top_k_other(df: DataFrame, col: str, k: int, out: str, unknown: str | None = "UNKNOWN") -> DataFrame:
    """``col`` with all but its k most frequent values replaced by OTHER.

    The broadcast side has k rows by construction.
    """
    key = F.col(col).cast("string")
    key = F.coalesce(key, F.lit(unknown)) if unknown else key
    top = top_values(df, col, k, unknown).select(F.col("value").alias("_top"))
    joined = df.withColumn("_key", key).join(F.broadcast(top), F.col("_key") == F.col("_top"), "left")
    return joined.withColumn(out, F.coalesce("_top", F.lit(OTHER))).drop("_key", "_top")


def top_value_list(df: DataFrame, col: str, k: int, unknown: str | None = "UNKNOWN") -> list[str]:
    """The k most frequent values for use as pivot columns; brings k short strings to the driver."""
    return [r["value"] for r in top_values(df, col, k, unknown).collect()]


def cell_counts(df: DataFrame, keys: Sequence[str], out: str = "ticket_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def mode_value(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value, the smallest on a tie; counts first, so the last step sees distinct values only."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.min_by(col, F.struct(-F.col("_n"), F.col(col))).alias(f"{col}_mode"))


def feature_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")) for c in cols]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def fit_scaler(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> DataFrame:
    """Mean and deviation per column; ``ddof`` 0 is the population, 1 the sample; zero becomes one."""
    std = F.stddev_pop if ddof == 0 else F.stddev_samp
    cells = []
    for c in cols:
        s = std(c)
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.avg(c).alias("mean"),
                F.when(F.coalesce(s, F.lit(0.0)) == 0, F.lit(1.0)).otherwise(s).alias("std"),
            )
        )
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def date_union(*dfs: DataFrame, date: str = "date") -> DataFrame:
    """All dates of several tables, each once; every table is reduced before the union."""
    parts = [d.select(date).distinct() for d in dfs]
    return reduce(DataFrame.unionByName, parts).distinct()


def group_mean(df: DataFrame, key: str, target: str, out: str) -> DataFrame:
    """Mean of ``target`` per key on every row.

    Aggregates first and joins back with a salt: a window by key would put a hot key on one task.
    """
    means = df.groupBy(key).agg(F.avg(target).alias(out))
    return attach(df, means, [key])


def fit_codes(train: DataFrame, col: str) -> DataFrame:
    """Code of each training value in sorted order, from 0. Runs the job that sorts the distinct values."""
    values = train.where(F.col(col).isNotNull()).select(col).distinct()
    return dense_ids(values, col, "_code").withColumn("_code", F.col("_code").cast("int"))


def apply_codes(df: DataFrame, codes: DataFrame, col: str, out: str) -> DataFrame:
    """Code of each row, -1 for a value not seen in training."""
    return attach(df, codes, [col]).withColumn(out, F.coalesce("_code", F.lit(-1))).drop("_code")
