"""Daily series to supervised set: gap filling, calendar, lags, rolling statistics, targets, split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, encode
from ..operators import aggregate, densify, forward, moments, splits, windows
from ..operators.moments import LinearModel
from ..session import materialize

TARGET = "num_violations"
HORIZONS = windows.HORIZONS


def daily_table(
    events: DataFrame, ts: str, series: str | None = None, pivot: str | None = None, top: int = 5,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Counts per day and series, with one column per frequent value of ``pivot`` and OTHER.

    The counts and the pivot are one aggregate over the events. Pass ``values`` to skip the job that
    finds the most frequent ones. Without ``series`` the whole city is one series.
    """
    rows = events.withColumns({"series_id": F.col(series) if series else F.lit("city"), "date": F.to_date(ts)})
    rows = rows.where(F.col("date").isNotNull())
    if pivot is None:
        return rows.groupBy("series_id", "date").agg(F.count(F.lit(1)).alias(TARGET))
    values = list(values) if values is not None else aggregate.top_value_list(events, pivot, top, unknown=None)
    label = F.when(F.col(pivot).isin(values), F.col(pivot)).otherwise(aggregate.OTHER)
    rows = rows.withColumn("_label", label)
    return aggregate.pivot_counts(rows, ["series_id", "date"], "_label", [*values, aggregate.OTHER], "", TARGET)


def with_features(daily: DataFrame, shares: Sequence[str] = ()) -> DataFrame:
    """The daily feature table. One shuffle by series serves the gap filling and every window."""
    df = densify.densify(daily)
    df = windows.add_lags(df, TARGET)
    df = windows.add_rolling(df, TARGET)
    c = F.col("date")
    cols = {
        "year": F.year(c),
        "month": F.month(c),
        "is_holiday": calendar.is_holiday(c).cast("int"),
        "is_weekend": calendar.is_weekend(c).cast("int"),
        "roc_vs_roll7": windows.rate_of_change(TARGET, f"{TARGET}_roll7_mean"),
        "is_cherry_blossom": calendar.in_season(c).cast("int"),
        "is_eom": calendar.is_month_end(c).cast("int"),
        **calendar.fourier_terms("date"),
        **encode.one_hot(calendar.weekday_name(c), calendar.WEEKDAYS, "dow"),
    }
    if shares:
        cols |= encode.shares(list(shares))
    return df.withColumns(cols)


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns that are known on the day: no key, no target, no label."""
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    skip = {TARGET, "date", "series_id", "is_imputed", "split"}
    return [c for c, t in df.dtypes if t in numeric and c not in skip and not c.startswith("y_t_plus_")]


def supervised(features: DataFrame, train_end, val_end, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Complete rows with their targets and split label."""
    df = windows.add_targets(features.drop("is_imputed"), TARGET, horizons)
    return splits.chrono_split(df.dropna(), train_end, val_end)


def one_day_rows(daily: DataFrame, lags: Sequence[int] = windows.DAILY_LAGS, rolling: Sequence[tuple[int, str]] = windows.DAILY_ROLLING, known=None) -> DataFrame:
    """Gap-free days, each with what was known the evening before: lags, rolling statistics up to the day before, and the date's own features."""
    df = densify.densify(daily)
    df = windows.add_lags(df, TARGET, list(lags)) if lags else df
    df = windows.add_rolling(df, TARGET, list(rolling), offset=1) if rolling else df
    return df.withColumns(known(F.col("date"))) if known else df


def fit_one_day(rows: DataFrame, features: Sequence[str]) -> LinearModel:
    """Least squares of a day's count on what was known before it; one row comes to the driver."""
    fit = moments.fit_linear(rows, features, [TARGET]).first()
    if fit is None:
        raise ValueError("no complete rows to fit")
    return LinearModel(tuple(features), fit.intercept, tuple(fit.weights))


def forecast_days(
    daily: DataFrame, days: int = 14, lags: Sequence[int] = windows.DAILY_LAGS, rolling: Sequence[tuple[int, str]] = windows.DAILY_ROLLING, known=None,
    until=None,
) -> tuple[DataFrame, LinearModel]:
    """The ``days`` days after the last one of each series, each forecast from the ones before it, and the model.

    One model is fitted over all series, on days up to ``until``. ``known`` maps a date column to numeric
    features that a date alone decides.
    """
    rows = materialize(one_day_rows(daily, lags, rolling, known), "one-day-rows")
    names = [f"{TARGET}_lag_{k}" for k in lags] + [f"{TARGET}_roll{n}_{s}" for n, s in rolling] + list(known(F.col("date")) if known else ())
    model = fit_one_day(rows if until is None else rows.where(F.col("date") <= F.lit(until).cast("date")), names)
    return forward.roll_forward(rows, model, TARGET, days, lags, rolling, known), model
