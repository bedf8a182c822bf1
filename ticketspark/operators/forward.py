"""Forecasts of days after the last one, each made from the days forecast before it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .moments import LinearModel
from .windows import SERIES

MEMORY = 30


def last_values(series: DataFrame, y: str, n: int = MEMORY, by: Sequence[str] = SERIES, date: str = "date") -> DataFrame:
    """by, last (date) and recent: the last n values of each series, oldest first.

    Only rows of the last n days are gathered. Nulls count as 0.
    """
    pair = F.struct(F.col(date).alias("d"), F.coalesce(F.col(y).cast("double"), F.lit(0.0)).alias("v"))
    rows = series.select(*by, date, pair.alias("p"))
    ends = rows.groupBy(*by).agg(F.max(date).alias("last"))
    near = rows.join(ends, list(by)).where(F.col(date) > F.date_sub("last", n))
    return near.groupBy(*by).agg(F.max("last").alias("last"), F.transform(F.sort_array(F.collect_list("p")), lambda p: p["v"]).alias("recent"))


def recency(recent: Column, y: str, lags: Sequence[int] = (), rolling: Sequence[tuple[int, str]] = (), size: int = MEMORY) -> dict[str, Column]:
    """Features of the day after ``recent``, named as ``windows.add_lags`` and ``add_rolling`` with ``offset=1`` name them.

    ``lag_k`` is k days before that day. ``recent`` must hold ``size`` values.
    """
    cols = {f"{y}_lag_{k}": F.get(recent, F.lit(size - k)) for k in lags}
    for n, stat in rolling:
        part = F.slice(recent, size - n + 1, n)
        mean = F.aggregate(part, F.lit(0.0).cast("double"), lambda s, x: s + x) / n
        if stat == "std":
            square = F.aggregate(part, F.lit(0.0).cast("double"), lambda s, x: s + (x - mean) * (x - mean))
            cols[f"{y}_roll{n}_std"] = F.sqrt(square / (n - 1))
        elif stat == "mean":
            cols[f"{y}_roll{n}_mean"] = mean
        else:
            raise ValueError(f"no rolling statistic {stat}")
    return cols


def roll_forward(
    history: DataFrame, model: LinearModel, y: str, days: int, lags: Sequence[int] = (1, 7, 14, 30), rolling: Sequence[tuple[int, str]] = ((7, "mean"), (30, "mean"), (30, "std")),
    known=None, by: Sequence[str] = SERIES, date: str = "date", floor: float | None = 0.0,
) -> DataFrame:
    """by, date, step and y_pred of the ``days`` days after the last one of each series.

    A day's prediction joins the values that the next day's lags and rolling statistics see. ``known``
    maps a date column to the features that a date alone decides. A series needs ``MEMORY`` gap-free days;
    shorter ones are left out. Predictions below ``floor`` become it (None keeps them). The days are
    one fold over an array within each row: nothing is shuffled after the history is read.
    """
    recent = last_values(history, y, MEMORY, by, date).where(F.size("recent") == MEMORY)

    def step(state: Column, k: Column) -> Column:
        values = state["recent"]
        on = F.date_add(F.col("last"), k)
        guess = model.predict({**(known(on) if known else {}), **recency(values, y, lags, rolling)})
        if floor is not None:
            guess = F.greatest(guess, F.lit(float(floor)))
        return F.struct(
            F.concat(F.slice(values, 2, MEMORY - 1), F.array(guess)).alias("recent"), F.concat(state["made"], F.array(guess)).alias("made")
        )

    start = F.struct(F.col("recent"), F.array().cast("array<double>").alias("made"))
    made = F.aggregate(F.sequence(F.lit(1), F.lit(days)), start, step, lambda s: s["made"])
    rows = recent.select(*by, "last", F.posexplode(made).alias("at", "y_pred"))
    return rows.select(*by, F.date_add("last", F.col("at") + 1).alias(date), (F.col("at") + 1).alias("step"), "y_pred")


def score_frame(frame: DataFrame, model: LinearModel, keep: Sequence[str] = ("series_id", "date"), defaults: Mapping[str, float] | None = None) -> DataFrame:
    """keep and y_pred of ready feature rows; a null feature counts as its default, else 0."""
    values = {f: F.coalesce(F.col(f).cast("double"), F.lit(float((defaults or {}).get(f, 0.0)))) for f in model.features}
    return frame.select(*keep, model.predict(values).alias("y_pred"))
