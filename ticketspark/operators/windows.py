"""Features over ordered series.

All frames count rows, so complete the series first (``densify``). Every window is partitioned by
``by``; a partition is one aggregated series, whose length is set by the calendar and not by the
number of events. Columns of one call share a single shuffle and sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES = ("series_id",)

# fixed values: lags and rolling windows of the daily feature table
DAILY_LAGS = [1, 7, 14, 30]
DAILY_ROLLING = [(7, "mean"), (30, "mean"), (30, "std")]
HORIZONS = [1, 3, 7]


def _order(by: Sequence[str], date: str):
    return Window.partitionBy(*by).orderBy(date)


def add_lags(
    df: DataFrame, y: str, lags: Sequence[int] = DAILY_LAGS, by: Sequence[str] = SERIES, date: str = "date",
    fill: float | None = None, name: str | None = None,
) -> DataFrame:
    """``y`` some rows back; nulls at the start become ``fill`` when given."""
    w = _order(by, date)
    name = name or f"{y}_lag"
    cols = {}
    for k in lags:
        c = F.lag(y, k).over(w)
        cols[f"{name}_{k}"] = c if fill is None else F.coalesce(c, F.lit(fill))
    return df.withColumns(cols)


def add_targets(
    df: DataFrame, y: str, horizons: Sequence[int] = HORIZONS, by: Sequence[str] = SERIES, date: str = "date",
    name: str = "y_t_plus", complete: bool = True,
) -> DataFrame:
    """``y`` some rows ahead; ``complete`` drops rows that lack a target."""
    w = _order(by, date)
    cols = {f"{name}_{h}": F.lead(y, h).over(w) for h in horizons}
    out = df.withColumns(cols)
    return out.dropna(subset=list(cols)) if complete else out


def target_mask(
    df: DataFrame, y: str, horizons: Sequence[int] = HORIZONS, by: Sequence[str] = SERIES, split: str = "split",
    date: str = "date",
) -> DataFrame:
    """Targets that never look beyond their own split: label 0 and mask 0 where none exists."""
    w = _order([*by, split], date)
    cols = {}
    for h in horizons:
        ahead = F.lead(y, h).over(w)
        cols[f"label_{h}"] = F.coalesce(ahead, F.lit(0))
        cols[f"mask_{h}"] = ahead.isNotNull().cast("int")
    return df.withColumns(cols)


def rolling(y: Column | str, n: int, stat: str, order, offset: int = 0, min_periods: int | None = None) -> Column:
    """Mean or sample deviation of the n rows that end ``offset`` rows back.

    Null until ``min_periods`` (n by default) values are in the frame.
    """
    y = F.col(y) if isinstance(y, str) else y
    frame = order.rowsBetween(-(n - 1) - offset, -offset)
    agg = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum}[stat]
    return F.when(F.count(y).over(frame) >= (min_periods or n), agg(y).over(frame))


def add_rolling(
    df: DataFrame, y: str, specs: Sequence[tuple[int, str]] = DAILY_ROLLING, by: Sequence[str] = SERIES,
    date: str = "date", offset: int = 0, min_periods: int | None = None, name: str | None = None,
) -> DataFrame:
    w = _order(by, date)
    name = name or y
    return df.withColumns({f"{name}_roll{n}_{s}": rolling(y, n, s, w, offset, min_periods) for n, s in specs})


def rate_of_change(y: str, mean: str) -> Column:
    """Deviation from a rolling mean, relative to it."""
    return (F.col(y) - F.col(mean)) / (F.col(mean) + 1e-6)


def naive_scale(
    df: DataFrame, y: str, until: Column | None = None, by: Sequence[str] = SERIES, date: str = "date",
    out: str = "naive_scale",
) -> DataFrame:
    """Mean absolute day-to-day change per series, over the rows ``until`` selects."""
    rows = df if until is None else df.where(until)
    step = F.abs(F.col(y) - F.lag(y, 1).over(_order(by, date)))
    return rows.select(*by, step.alias("_step")).groupBy(*by).agg(F.avg("_step").alias(out))


def difference(
    df: DataFrame, y: str, season: int = 7, by: Sequence[str] = SERIES, date: str = "date", out: str = "diff"
) -> DataFrame:
    """One regular and one seasonal difference."""
    w = _order(by, date)
    regular = F.col(y) - F.lag(y, 1).over(w)
    seasonal = F.lag(y, season).over(w) - F.lag(y, season + 1).over(w)
    return df.withColumn(out, regular - seasonal)


def sequences(
    df: DataFrame, y: str, lookback: int = 30, horizons: Sequence[int] = HORIZONS, by: Sequence[str] = SERIES,
    date: str = "date",
) -> DataFrame:
    """The previous ``lookback`` values and the values at each horizon as arrays.

    The row at position i holds the rows before i; horizon h is row i + h - 1 and ``label_date`` is
    the date of the last horizon.
    """
    w = _order(by, date)
    last = max(horizons) - 1
    out = df.select(
        *by,
        date,
        F.collect_list(F.col(y).cast("double")).over(w.rowsBetween(-lookback, -1)).alias("history"),
        F.array(*[F.lead(F.col(y).cast("double"), h - 1).over(w) for h in horizons]).alias("targets"),
        F.lead(date, last).over(w).alias("label_date"),
    )
    return out.where((F.size("history") == lookback) & F.col("label_date").isNotNull())


def days_since_start(df: DataFrame, by: Sequence[str] = SERIES, date: str = "date", out: str = "days_since_start") -> DataFrame:
    first = F.min(date).over(Window.partitionBy(*by))
    return df.withColumn(out, F.date_diff(F.col(date), first))


def tail_rows(df: DataFrame, n: int, by: Sequence[str] = SERIES, date: str = "date") -> DataFrame:
    """The last n rows of each series; tasks drop older rows before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.desc(date))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
