"""Forecast errors as sums, so that every level of a report comes from one small table.

``error_sums`` lists plain sums and counts. Sums add up over any grouping; ``finish`` turns them
into the published measures.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-8


def _pair(y, p) -> tuple[Column, Column]:
    y = F.col(y) if isinstance(y, str) else y
    p = F.col(p) if isinstance(p, str) else p
    return y.cast("double"), p.cast("double")


def _ape(y: Column, p: Column, kind: str) -> Column:
    """One absolute percentage error; the kinds differ in the divisor."""
    err = F.abs(y - p)
    if kind == "floor1":
        return err / F.greatest(y, F.lit(1.0))
    if kind == "abs_floor1":
        return err / F.greatest(F.abs(y), F.lit(1.0))
    if kind == "abs_eps":
        return err / (F.abs(y) + EPS)
    if kind == "skip_zero":
        return F.when(F.abs(y) > EPS, err / F.abs(y))
    if kind == "plus_eps":
        return F.abs((y - p) / (y + EPS))
    raise ValueError(f"unknown percentage error {kind!r}")


def _sape(y: Column, p: Column, kind: str) -> Column:
    err = F.abs(y - p)
    if kind == "sum":
        return 2.0 * err / (F.abs(y) + F.abs(p) + EPS)
    if kind == "half":
        return err / F.greatest((F.abs(y) + F.abs(p)) / 2.0, F.lit(EPS))
    raise ValueError(f"unknown symmetric error {kind!r}")


def mae(y, p) -> Column:
    y, p = _pair(y, p)
    return F.avg(F.abs(y - p))


def mse(y, p) -> Column:
    y, p = _pair(y, p)
    return F.avg((y - p) * (y - p))


def rmse(y, p) -> Column:
    return F.sqrt(mse(y, p))


def mape(y, p, kind: str) -> Column:
    """Mean absolute percentage error; name the kind, there is no default."""
    y, p = _pair(y, p)
    return F.avg(_ape(y, p, kind)) * 100.0


def smape(y, p, kind: str) -> Column:
    y, p = _pair(y, p)
    return F.avg(_sape(y, p, kind)) * 100.0


def wape(y, p) -> Column:
    y, p = _pair(y, p)
    return F.sum(F.abs(y - p)) / (F.sum(F.abs(y)) + EPS) * 100.0


def r2(y, p) -> Column:
    y, p = _pair(y, p)
    return 1.0 - F.sum((y - p) * (y - p)) / (F.var_pop(y) * F.count(y))


def log_mae(y, p_log) -> Column:
    """Error against log1p of the count; the forecast is in log space already."""
    y, p = _pair(y, p_log)
    return F.avg(F.abs(F.log1p(F.greatest(y, F.lit(0.0))) - p))


def log_rmse(y, p_log) -> Column:
    y, p = _pair(y, p_log)
    e = F.log1p(F.greatest(y, F.lit(0.0))) - p
    return F.sqrt(F.avg(e * e))


def masked_rmse(y, p, mask: Column | None = None) -> Column:
    """Root mean square over rows whose label exists; a null label is masked out."""
    y, p = _pair(y, p)
    m = y.isNotNull().cast("double") if mask is None else mask.cast("double")
    e = F.coalesce(y, F.lit(0.0)) - p
    return F.sqrt(F.sum(e * e * m) / (F.sum(m) + EPS))


# fixed values: weight of each horizon in the smooth loss
HORIZON_WEIGHTS = {1: 1.3, 3: 1.1, 7: 1.0}


def smooth_l1(y, p, horizon: Column, beta: float = 0.2, weights: dict = HORIZON_WEIGHTS) -> Column:
    """Weighted mean of the loss that is square below ``beta`` and linear above."""
    y, p = _pair(y, p)
    e = F.abs(y - p)
    loss = F.when(e < beta, 0.5 * e * e / beta).otherwise(e - 0.5 * beta)
    w = F.lit(1.0)
    for h, weight in weights.items():
        w = F.when(horizon == h, F.lit(float(weight))).otherwise(w)
    w = F.when(y.isNotNull(), w).otherwise(F.lit(0.0))
    return F.sum(F.coalesce(loss, F.lit(0.0)) * w) / (F.sum(w) + EPS)


def error_sums(y="y_true", p="y_pred") -> list[Column]:
    """Counts and sums from which ``finish`` derives the report measures."""
    y, p = _pair(y, p)
    e = F.abs(y - p)
    return [
        F.count(e).alias("s_n"),
        F.sum(e).alias("s_abs"),
        F.sum(e * e).alias("s_sq"),
        F.sum(_ape(y, p, "skip_zero")).alias("s_ape"),
        F.count(_ape(y, p, "skip_zero")).alias("s_ape_n"),
        F.sum(_sape(y, p, "sum")).alias("s_sape"),
        F.sum(F.abs(y)).alias("s_y"),
    ]


SUM_NAMES = ["s_n", "s_abs", "s_sq", "s_ape", "s_ape_n", "s_sape", "s_y"]


def add_up(names: Iterable[str] = SUM_NAMES) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def finish() -> dict[str, Column]:
    """Report measures from the sums."""
    n = F.col("s_n")
    return {
        "mae": F.col("s_abs") / n,
        "rmse": F.sqrt(F.col("s_sq") / n),
        "mape": F.when(F.col("s_ape_n") > 0, F.col("s_ape") / F.col("s_ape_n") * 100.0),
        "smape": F.col("s_sape") / n * 100.0,
        "wape": F.col("s_abs") / (F.col("s_y") + EPS) * 100.0,
        "n": n,
    }
