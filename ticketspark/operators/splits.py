"""Chronological splits, folds and reproducible samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach
from .ordering import hash_cuts, hash_ranked, order_value

SERIES = ("series_id",)


def chrono_label(date: Column, train_end, val_end) -> Column:
    train_end, val_end = F.lit(train_end).cast("date"), F.lit(val_end).cast("date")
    return F.when(date <= train_end, "train").when(date <= val_end, "val").otherwise("test")


def chrono_split(df: DataFrame, train_end, val_end, date: str = "date") -> DataFrame:
    """One label column: train up to ``train_end``, val up to ``val_end``, test after."""
    return df.withColumn("split", chrono_label(F.col(date), train_end, val_end))


def _position(df: DataFrame, by: Sequence[str], date: str) -> DataFrame:
    w = Window.partitionBy(*by)
    return df.withColumns({"_pos": F.row_number().over(w.orderBy(date)), "_n": F.count(F.lit(1)).over(w)})


def fraction_split(
    df: DataFrame, test: float = 0.3, val: float = 0.1, by: Sequence[str] = SERIES, date: str = "date"
) -> DataFrame:
    """Last part of each series for test, and the last part of the rest for validation; at least one row each."""
    rows = _position(df, by, date)
    n_test = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(test)))
    n_train = F.col("_n") - n_test
    n_val = F.greatest(F.lit(1), F.floor(n_train * F.lit(val))) if val else F.lit(0)
    label = F.when(F.col("_pos") > n_train, "test").when(F.col("_pos") > n_train - n_val, "val").otherwise("train")
    return rows.withColumn("split", label).drop("_pos", "_n")


def head_split(
    df: DataFrame, train: float = 0.7, val: float = 0.15, by: Sequence[str] = SERIES, date: str = "date"
) -> DataFrame:
    """First fractions of each series for train and validation, counted from the start."""
    rows = _position(df, by, date)
    label = (
        F.when(F.col("_pos") <= F.floor(F.col("_n") * F.lit(train)), "train")
        .when(F.col("_pos") <= F.floor(F.col("_n") * F.lit(train + val)), "val")
        .otherwise("test")
    )
    return rows.withColumn("split", label).drop("_pos", "_n")


def tail_split(df: DataFrame, test: float = 0.2, by: Sequence[str] = SERIES, date: str = "date") -> DataFrame:
    """Last ``ceil(test * n)`` rows of each series for test, the rest for train."""
    rows = _position(df, by, date)
    n_test = F.ceil(F.col("_n") * F.lit(test))
    label = F.when(F.col("_pos") > F.col("_n") - n_test, "test").otherwise("train")
    return rows.withColumn("split", label).drop("_pos", "_n")


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], test: float = 0.2, val_share: float = 0.125, seed: int = 42
) -> DataFrame:
    """Random train, val and test parts with the same share of every label.

    ``test`` is held out of each label; ``val_share`` of that part is for validation. Cut points per
    label decide, so the rows are filtered where they are.
    """
    n = F.col("n")
    held = F.ceil(n * F.lit(test))
    wanted = {"_train": n - held, "_val": n - held + F.floor(held * F.lit(val_share))}
    cuts = hash_cuts(df, key, wanted, [label], seed)
    rows = attach(df, cuts, [label])
    at = order_value(key, seed)
    split = F.when(at <= F.col("_train"), "train").when(at <= F.col("_val"), "val").otherwise("test")
    return rows.withColumn("split", split).drop("_train", "_val")


def downsample_negatives(
    df: DataFrame, key: Sequence[str], label: str = "label", ratio: float = 1.0, seed: int = 42
) -> DataFrame:
    """All positives and exactly min(negatives, positives * ratio) random negatives.

    Fails when there is no positive row. One cut point selects the negatives; nothing is sorted.
    """
    positives = F.count_if(F.col(label) == 1)
    target = df.agg(
        F.when(positives == 0, F.raise_error(F.lit("no positive samples")).cast("long")).otherwise(
            F.floor(positives * F.lit(float(ratio)))
        ).alias("goal")
    ).scalar()
    cut = hash_cuts(df.where(F.col(label) == 0), key, {"_cut": target}, seed=seed)
    at = order_value(key, seed)
    return df.where((F.col(label) == 1) | F.coalesce(at <= cut.scalar(), F.lit(False)))


def rolling_origin(
    df: DataFrame, k: int = 3, warmup: int = 365, tail: int = 90, date: str = "date"
) -> DataFrame:
    """k copies of the rows: train up to the fold's cutoff, test after it.

    Cutoffs are evenly spaced between ``warmup`` days after the first date and ``tail`` days before
    the last one; the first point is left out.
    """
    ends = df.agg(
        F.struct(F.date_add(F.min(date), warmup).alias("lo"), F.date_sub(F.max(date), tail).alias("hi"))
    ).scalar()
    lo, hi = F.col("_ends.lo"), F.col("_ends.hi")
    folds = F.array(
        *[
            F.struct(
                F.lit(i).alias("fold"),
                F.date_add(lo, F.floor(F.date_diff(hi, lo) * F.lit(i) / F.lit(k)).cast("int")).alias("cutoff"),
            )
            for i in range(1, k + 1)
        ]
    )
    rows = df.withColumn("_ends", ends).select(*df.columns, F.inline(folds))
    return rows.withColumn("split", F.when(F.col(date) <= F.col("cutoff"), "train").otherwise("test"))


def prefix_sizes(points: int = 10, first: float = 0.2) -> list[float]:
    """Evenly spaced fractions up to one."""
    step = (1.0 - first) / (points - 1)
    return [first + step * i for i in range(points - 1)] + [1.0]


def learning_prefixes(
    df: DataFrame, fractions: Sequence[float] | None = None, floor: int = 20, by: Sequence[str] = SERIES, date: str = "date"
) -> DataFrame:
    """For each fraction the first rows of the series, at least ``floor`` of them."""
    fractions = fractions or prefix_sizes()
    rows = _position(df, by, date).withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
    keep = F.col("_pos") <= F.greatest(F.lit(floor), F.floor(F.col("_n") * F.col("fraction")))
    return rows.where(keep).drop("_pos", "_n")


def shuffled(df: DataFrame, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Reproducible random position of every row."""
    return hash_ranked(df, key, seed=seed, rank="position").drop("group_rows")
