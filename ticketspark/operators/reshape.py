"""Long and wide prediction tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Rows of all tables; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def tidy_predictions(wide: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Columns named ``<model> t+<h>`` to rows of model, horizon and value; empty cells are left out."""
    labels = [c for c in wide.columns if c not in keys]
    long = wide.unpivot(list(keys), labels, "label", "y_pred")
    model = F.split("label", r" t\+")
    return long.where(F.col("y_pred").isNotNull()).select(
        *keys,
        model[0].alias("model"),
        model[1].cast("int").alias("horizon"),
        F.col("y_pred").cast("double").alias("y_pred"),
    )


def wide_predictions(long: DataFrame, models: Sequence[str], keys: Sequence[str] = ("date",)) -> DataFrame:
    """One row per key with the actual value and one column per model."""
    cols = [F.max(F.when(F.col("model") == m, F.col("y_pred"))).alias(m) for m in models]
    return long.groupBy(*keys).agg(F.max("y_true").alias("actual"), *cols)


def multi_target(supervised: DataFrame, keys: Sequence[str], horizons: Sequence[int], prefix: str = "y_t_plus") -> DataFrame:
    """One row per key and horizon with its target; features stay as columns."""
    targets = [f"{prefix}_{h}" for h in horizons]
    others = [c for c in supervised.columns if c not in targets]
    pairs = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(t).cast("double").alias("y")) for h, t in zip(horizons, targets)])
    return supervised.select(*others, F.inline(pairs))


def ensemble_mean(preds: DataFrame, keys: Sequence[str] = ("date", "horizon")) -> DataFrame:
    """Mean prediction over the members of an ensemble."""
    return preds.groupBy(*keys).agg(F.avg("y_pred").alias("y_pred"))
