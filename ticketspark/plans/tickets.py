"""Ticket events to a forecast per cell: daily matrix, fit, calibration, forecast, allocation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar
from ..operators import aggregate, clean, densify, evaluate, models, spatial, splits, windows
from ..session import materialize

# fixed values: how many agencies and violation codes keep their own column
TOP_AGENCIES, TOP_VIOLATIONS = 10, 20
CALENDAR = ["day_of_week", "is_weekend", "is_holiday", "week_of_year", "month", "day_of_month", "days_since_start"]


def calendar_features(date: str = "date") -> dict:
    c = F.col(date)
    return {
        "day_of_week": F.weekday(c),
        "is_weekend": calendar.is_weekend(c).cast("int"),
        "is_holiday": calendar.is_holiday(c).cast("int"),
        "week_of_year": F.weekofyear(c),
        "month": F.month(c),
        "day_of_month": F.dayofmonth(c),
    }


def daily_matrix(
    events: DataFrame, agency: str | None = None, violation: str | None = None, series: str | None = None,
    lagged_counts: bool = False,
) -> DataFrame:
    """Tickets per day with calendar columns, counts of frequent agencies and violations, and recency.

    All counts are one aggregate over the events. ``lagged_counts`` uses the counts of the day
    before, so that training sees what a forecast will see.
    """
    rows = clean.resolve_event_time(events).where(F.col("event_ts").isNotNull())
    rows = rows.withColumns({"date": F.to_date("event_ts"), "series_id": F.col(series) if series else F.lit("city")})
    counts = [F.count(F.lit(1)).alias("tickets")]
    names = []
    for col, k, prefix in ((agency, TOP_AGENCIES, "agency"), (violation, TOP_VIOLATIONS, "viol")):
        if col is None:
            continue
        key = F.coalesce(F.col(col).cast("string"), F.lit(clean.UNKNOWN))
        top = aggregate.top_value_list(events, col, k)
        counts += [F.count_if(key == v).alias(f"{prefix}_{v}") for v in top]
        counts.append(F.count_if(~key.isin(top)).alias(f"{prefix}_OTHER"))
        names += [f"{prefix}_{v}" for v in [*top, "OTHER"]]
    df = rows.groupBy("series_id", "date").agg(*counts)
    df = windows.days_since_start(df.withColumns(calendar_features()))
    df = windows.add_lags(df, "tickets", [1, 3, 7], fill=0, name="lag")
    df = windows.add_rolling(df, "tickets", [(7, "mean")], min_periods=1, name="_ma")
    df = df.withColumnRenamed("_ma_roll7_mean", "ma_7")
    if lagged_counts and names:
        w = Window.partitionBy(*windows.SERIES).orderBy("date")
        df = df.withColumns({c: F.coalesce(F.lag(c, 1).over(w), F.lit(0)) for c in names})
    return df


def matrix_features(matrix: DataFrame) -> list[str]:
    keep = ("agency_", "viol_", "lag_")
    return [c for c in matrix.columns if c in CALENDAR or c == "ma_7" or c.startswith(keep)]


def future_frame(matrix: DataFrame, features: Sequence[str], days: int) -> DataFrame:
    """Feature rows of the days after each series' last one: calendar columns are known, the rest counts as 0."""
    starts = matrix.groupBy("series_id").agg(F.min("date").alias("_start"))
    future = densify.future_dates(matrix, days).join(starts, "series_id")
    known = {**calendar_features(), "days_since_start": F.date_diff("date", "_start")}
    return densify.future_features(future, features, known, ["series_id", "date"])


def fit_and_forecast(
    matrix: DataFrame, fits: dict[str, models.Fit], days: int = 14, horizons: Sequence[int] = windows.HORIZONS,
    calibrate: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Test predictions, their metrics and the forecast of the days after the last one.

    Fits on the first part of each series, learns the scale on validation rows, reports on the rest.
    The matrix is written once, as every fit reads it.
    """
    features = matrix_features(matrix)
    matrix = materialize(matrix, "daily-matrix")
    rows = windows.add_targets(splits.fraction_split(matrix), "tickets", horizons)
    preds, fitted = models.train_all(rows, fits, features, horizons)
    keys = ["model", "horizon"]
    scales = evaluate.fit_scale(preds.where("split = 'val'"), keys)
    test = preds.where("split = 'test'")
    test = evaluate.apply_scale(test, scales, keys) if calibrate else test
    frame = future_frame(matrix, features, days)
    ahead = models.forecast(fitted, frame, features)
    ahead = evaluate.apply_scale(ahead, scales, keys) if calibrate else ahead
    return test, evaluate.summarize(test, keys), ahead


def allocate_forecast(ahead: DataFrame, events: DataFrame, model: str, horizon: int) -> DataFrame:
    """One model's and horizon's forecast per target date spread over the grid.

    Several series of a date are added up. ``events`` has date parts and cell ids.
    """
    chosen = ahead.where((F.col("model") == model) & (F.col("horizon") == horizon))
    per_day = chosen.groupBy("date").agg(F.sum("y_pred").alias("y_pred"))
    return spatial.allocate(per_day, spatial.spatial_weights(events))
