"""Probability models as relations: one row for each level of each feature, scored by joins.

A relation has ``feature``, ``level`` and ``weight``. Rows with a null level hold the intercept and the
slopes of continuous features, all others the weight of one level of a coded feature. The log odds of
a row are the intercept plus the weights of its levels and its values times their slopes. A level that
the relation does not list weighs nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attach

INTERCEPT = "intercept"
RELATION = "feature string, level long, weight double"


def level_counts(samples: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """feature, level, trials and hits of every level, and one row ``intercept`` with a null level for all rows.

    Rows collapse to distinct combinations of levels before they are written out by feature, so a
    crowded level never moves row by row. Rows with a null label are left out, as are null levels.
    """
    codes = [F.col(c).cast("long").alias(c) for c in features]
    hit = F.col(label).cast("long")
    cells = samples.where(F.col(label).isNotNull()).groupBy(*codes).agg(F.count(F.lit(1)).alias("trials"), F.sum(hit).alias("hits"))
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("level")) for c in features]
    whole = F.struct(F.lit(INTERCEPT).alias("feature"), F.lit(None).cast("long").alias("level"))
    listed = cells.select("trials", "hits", F.inline(F.array(*rows, whole)))
    listed = listed.where(F.col("level").isNotNull() | (F.col("feature") == INTERCEPT))
    return listed.groupBy("feature", "level").agg(F.sum("trials").alias("trials"), F.sum("hits").alias("hits"))


def level_weights(counts: DataFrame, prior: float = 1.0) -> DataFrame:
    """feature, level, weight, trials and hits: log odds of each level beside those of all rows.

    Each level is drawn to the rate of all rows as by ``prior`` more trials, so a level of few trials
    weighs little. Levels are weighed each for itself: right where the features are independent among
    hits and among misses, a baseline otherwise.
    """
    whole = counts.where(F.col("feature") == INTERCEPT)
    rate = whole.agg(F.first((F.col("hits") + 0.5) / (F.col("trials") + 1.0)).alias("p")).scalar()
    odds = F.log(rate / (1.0 - rate))
    own = F.log((F.col("hits") + prior * rate) / (F.col("trials") - F.col("hits") + prior * (1.0 - rate)))
    weight = F.when(F.col("feature") == INTERCEPT, odds).otherwise(own - odds)
    return counts.select("feature", "level", weight.alias("weight"), "trials", "hits")


def relation_of(model: PipelineModel, df: DataFrame, codes: Sequence[str], continuous: Sequence[str]) -> DataFrame:
    """The relation of a fitted pipeline of one-hot encoder, assembler (``continuous`` first) and logistic regression.

    Its coefficients are on the driver already, one for each level.
    """
    encoder, _, logistic = model.stages
    values = [float(v) for v in logistic.coefficients.toArray()]
    rows = [(INTERCEPT, None, float(logistic.intercept)), *[(c, None, v) for c, v in zip(continuous, values)]]
    at = len(continuous)
    for name, size in zip(codes, encoder.categorySizes):
        rows += [(name, level, values[at + level]) for level in range(size)]
        at += size
    if at != len(values):
        raise ValueError(f"the model has {len(values)} coefficients, the features have {at}")
    return df.sparkSession.createDataFrame(rows, RELATION)


def score_by_weights(
    rows: DataFrame, relation: DataFrame, codes: Sequence[str], continuous: Sequence[str] = (), out: str = "score"
) -> DataFrame:
    """``rows`` with the probability that the relation gives them; a null code or value weighs nothing.

    One join for each coded feature, in which the rows stay where they are while its levels are few
    enough to broadcast. The terms without level, one for each feature, are a scalar subquery.
    """
    plain = relation.where(F.col("level").isNull())
    slopes = plain.agg(F.map_from_entries(F.collect_list(F.struct("feature", "weight"))).alias("m")).scalar()

    def or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0.0))

    total = or_zero(F.element_at(slopes, INTERCEPT))
    for c in continuous:
        total = total + or_zero(F.element_at(slopes, c) * F.col(c))
    for i, c in enumerate(codes):
        levels = relation.where((F.col("feature") == c) & F.col("level").isNotNull())
        rows = rows.withColumn(f"_level_{i}", F.col(c).cast("long"))
        rows = attach(rows, levels.select(F.col("level").alias(f"_level_{i}"), F.col("weight").alias(f"_weight_{i}")), [f"_level_{i}"])
        total = total + or_zero(F.col(f"_weight_{i}"))
    scored = rows.withColumn(out, 1.0 / (1.0 + F.exp(-total)))
    return scored.drop(*[f"_{part}_{i}" for i in range(len(codes)) for part in ("level", "weight")])
