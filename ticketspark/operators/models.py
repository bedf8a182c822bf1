"""MLlib models over feature tables.

Fits run on the executors. The driver loops over models and horizons only, and receives
coefficients, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar, encode, metrics
from ..session import materialize
from . import splits, windows
from .levels import score_by_weights
from .ordering import hash_ranked
from .reshape import union_by_name
from .spatial import snap_to_cell

LABEL = "label"
Fit = Callable[[DataFrame, Sequence[str]], PipelineModel]


def _assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out)


def ready(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Finite double features and the target as ``label``; rows without target are left out."""
    cols = {c: encode.finite(F.col(c)) for c in features}
    return df.where(F.col(target).isNotNull()).withColumns({**cols, LABEL: F.col(target).cast("double")})


def linear(df: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Least squares on standardised features."""
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[_assembler(features, "raw"), scaler, LinearRegression(labelCol=LABEL)]).fit(df)


def contiguous_folds(df: DataFrame, k: int = 5, date: str = "date", out: str = "fold") -> DataFrame:
    """Fold number by date, k runs of about equal length. The window sees distinct dates only."""
    w = Window.partitionBy(F.lit(1))
    dates = df.select(date).distinct()
    pos = F.row_number().over(w.orderBy(date)) - 1
    dates = dates.withColumn(out, F.floor(pos * k / F.count(F.lit(1)).over(w)).cast("int"))
    return df.join(dates, date)


def alpha_path(df: DataFrame, features: Sequence[str], n: int = 10, ratio: float = 1e-3) -> list[float]:
    """Penalties from the smallest that empties the model down to ``ratio`` of it, evenly spaced in logs."""
    row = df.agg(F.stddev_samp(LABEL).alias("s"), *[F.corr(F.col(c).cast("double"), F.col(LABEL)).alias(f"c{i}") for i, c in enumerate(features)]).first()
    corr = [abs(row[f"c{i}"] or 0.0) for i in range(len(features))]
    corr = [c for c in corr if c == c]
    top = max(corr, default=0.0) * (row["s"] or 0.0) or 1.0
    return [top * ratio ** (i / (n - 1)) for i in range(n)]


def lasso_cv(
    df: DataFrame, features: Sequence[str], folds: int = 5, alphas: Sequence[float] | None = None, parallelism: int = 8
) -> PipelineModel:
    """Lasso with the penalty chosen over contiguous folds."""
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    prep = Pipeline(stages=[_assembler(features, "raw"), scaler]).fit(df)
    rows = contiguous_folds(prep.transform(df).select("date", "features", LABEL), folds)
    lasso = LinearRegression(labelCol=LABEL, elasticNetParam=1.0)
    grid = ParamGridBuilder().addGrid(lasso.regParam, list(alphas or alpha_path(df, features))).build()
    cv = CrossValidator(
        estimator=lasso,
        estimatorParamMaps=grid,
        evaluator=RegressionEvaluator(labelCol=LABEL, metricName="mse"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    return PipelineModel(stages=[*prep.stages, cv.fit(rows.persist()).bestModel])


def forest(trees: int = 500, seed: int = 42, depth: int = 10) -> Fit:
    """Random forest in which every split may use every feature."""

    def fit(df: DataFrame, features: Sequence[str]) -> PipelineModel:
        model = RandomForestRegressor(
            labelCol=LABEL, numTrees=trees, seed=seed, maxDepth=depth, featureSubsetStrategy="all"
        )
        return Pipeline(stages=[_assembler(features), model]).fit(df)

    return fit


def gbt(trees: int = 100, seed: int = 42, depth: int = 3, step: float = 0.1) -> Fit:
    """Gradient-boosted trees."""

    def fit(df: DataFrame, features: Sequence[str]) -> PipelineModel:
        model = GBTRegressor(labelCol=LABEL, maxIter=trees, seed=seed, maxDepth=depth, stepSize=step)
        return Pipeline(stages=[_assembler(features), model]).fit(df)

    return fit


def gbt_early_stop(trees: int = 600, seed: int = 42, step: float = 0.08, leaf: int = 10, held: float = 0.1) -> Fit:
    """Boosting that stops when a held-out part of the training rows no longer improves.

    The held part is picked by a hash of the row, so it is the same in every run.
    """

    def fit(df: DataFrame, features: Sequence[str]) -> PipelineModel:
        pick = F.pmod(F.xxhash64(*[F.col(c) for c in features], F.lit(seed)), F.lit(1000)) < int(held * 1000)
        model = GBTRegressor(
            labelCol=LABEL, maxIter=trees, seed=seed, stepSize=step, minInstancesPerNode=leaf, validationIndicatorCol="held"
        )
        return Pipeline(stages=[_assembler(features), model]).fit(df.withColumn("held", pick))

    return fit


def importances(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature importances of a tree model as a table of one row per feature."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(float(v)).alias("importance")) for f, v in zip(features, values)])
    return df.sparkSession.range(1).select(F.inline(pairs))


def score(model: PipelineModel, df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """Predictions in the long form: keys, actual and predicted value."""
    out = model.transform(ready(df, features, target))
    return out.select(*keys, F.col(LABEL).alias("y_true"), F.col("prediction").alias("y_pred"))


def train_all(
    supervised: DataFrame, models: dict[str, Fit], features: Sequence[str], horizons: Sequence[int] = windows.HORIZONS,
    keys: Sequence[str] = ("series_id",), prefix: str = "y_t_plus",
) -> tuple[DataFrame, dict[tuple[str, int], PipelineModel]]:
    """Fit each model for each horizon on the train split; long predictions for all later rows.

    Predictions carry the date they are for.
    """
    train, later = supervised.where("split = 'train'"), supervised.where("split <> 'train'")
    fitted, parts = {}, []
    for h in horizons:
        target = f"{prefix}_{h}"
        rows = ready(train, features, target).persist()
        for name, fit in models.items():
            fitted[name, h] = model = fit(rows, features)
            p = score(model, later, features, target, [*keys, "date", "split"])
            p = p.withColumns({"date": calendar.target_date(F.col("date"), h), "horizon": F.lit(h), "model": F.lit(name)})
            parts.append(p)
        rows.unpersist()
    return union_by_name(*parts), fitted


def forecast(
    fitted: dict[tuple[str, int], PipelineModel], future: DataFrame, features: Sequence[str], keys: Sequence[str] = ("series_id",)
) -> DataFrame:
    """Predictions of every fitted model for feature rows of future days, dated by what they predict."""
    rows = future.withColumns({c: encode.finite(F.col(c)) for c in features})
    parts = []
    for (name, h), model in fitted.items():
        p = model.transform(rows).select(*keys, calendar.target_date(F.col("date"), h).alias("date"), F.col("prediction").alias("y_pred"))
        parts.append(p.withColumns({"horizon": F.lit(h), "model": F.lit(name)}))
    return union_by_name(*parts)


AR_LAGS = [1, 7, 8]


def seasonal_ar(
    series: DataFrame, y: str, train: Column, horizons: Sequence[int] = windows.HORIZONS,
    by: Sequence[str] = windows.SERIES, date: str = "date",
) -> DataFrame:
    """Autoregression on the seasonally differenced series, forecast from the history up to each day.

    One least-squares fit gives the coefficients. Steps ahead are then column arithmetic over lags,
    so all days are forecast in one pass with no refit. Horizons reach a season at most.
    """
    w = Window.partitionBy(*by).orderBy(date)
    df = windows.difference(series, y, 7, by, date, "_z")
    df = windows.add_lags(df, "_z", AR_LAGS, by, date, name="_z")
    rows = df.where(train).dropna(subset=["_z", *[f"_z_{k}" for k in AR_LAGS]])
    features = [f"_z_{k}" for k in AR_LAGS]
    ar = Pipeline(stages=[_assembler(features), LinearRegression(labelCol=LABEL)]).fit(rows.withColumn(LABEL, F.col("_z").cast("double")))
    a, (b1, b7, b8) = float(ar.stages[-1].intercept), (float(c) for c in ar.stages[-1].coefficients)

    def past(c: str, back: int) -> Column:
        return F.col(c).cast("double") if back == 0 else F.lag(F.col(c).cast("double"), back).over(w)

    known = {f"_y_b{k}": past(y, k) for k in range(8)} | {f"_z_b{k}": past("_z", k) for k in range(8)}
    known |= {f"_t{h}": F.lead(F.col(y).cast("double"), h).over(w) for h in horizons}
    df = df.withColumns(known)
    z, level, steps = F.col("_z_b0"), F.col("_y_b0"), {}
    for k in range(1, max(horizons) + 1):
        z = a + b1 * z + b7 * F.col(f"_z_b{7 - k}") + b8 * F.col(f"_z_b{8 - k}")
        level = z + level + F.col(f"_y_b{7 - k}") - F.col(f"_y_b{8 - k}")
        steps[k] = level
    guesses = F.array(
        *[F.struct(F.lit(h).alias("horizon"), F.col(f"_t{h}").alias("y_true"), steps[h].alias("y_pred")) for h in horizons]
    )
    out = df.select(*by, date, F.inline(guesses))
    out = out.where(F.col("y_pred").isNotNull())
    return out.withColumn(date, calendar.target_date(F.col(date), F.col("horizon")))


def backtest(
    supervised: DataFrame, fit: Fit, features: Sequence[str], horizons: Sequence[int] = windows.HORIZONS, k: int = 3,
    prefix: str = "y_t_plus",
) -> DataFrame:
    """Error of a model refitted at each rolling origin, per fold and horizon."""
    parts = []
    for h in horizons:
        target = f"{prefix}_{h}"
        folds = splits.rolling_origin(ready(supervised, features, target), k).persist()
        for fold in range(1, k + 1):
            one = folds.where(F.col("fold") == fold)
            model = fit(one.where("split = 'train'"), features)
            p = model.transform(one.where("split = 'test'"))
            errors = p.agg(
                metrics.mae(LABEL, "prediction").alias("mae"), metrics.rmse(LABEL, "prediction").alias("rmse")
            )
            parts.append(errors.select(F.lit(fold).alias("fold"), F.lit(h).alias("horizon"), "mae", "rmse"))
    return union_by_name(*parts)


def learning_curve(
    supervised: DataFrame, fit: Fit, features: Sequence[str], target: str, fractions: Sequence[float] | None = None,
    by: Sequence[str] = windows.SERIES,
) -> DataFrame:
    """Train and validation RMSE of a model fitted on growing first parts of the training rows."""
    fractions = list(fractions or splits.prefix_sizes())
    rows = ready(supervised, features, target)
    prefixes = splits.learning_prefixes(rows.where("split = 'train'"), fractions, by=by).persist()
    val = rows.where("split = 'val'")
    parts = []
    for f in fractions:
        train = prefixes.where(F.col("fraction") == F.lit(float(f)))
        model = fit(train, features)
        both = union_by_name(
            model.transform(train).select(F.lit("train").alias("part"), LABEL, "prediction"),
            model.transform(val).select(F.lit("val").alias("part"), LABEL, "prediction"),
        )
        e = F.col(LABEL) - F.col("prediction")
        cols = [F.sqrt(F.avg(F.when(F.col("part") == p, e * e))).alias(f"{p}_rmse") for p in ("train", "val")]
        parts.append(both.agg(*cols).select(F.lit(float(f)).alias("fraction"), "train_rmse", "val_rmse"))
    return union_by_name(*parts)


def dealings(n: int, repeats: int, seed: int = 42) -> list[tuple[int, int]]:
    """(step, shift) of each repeat: i -> (step * i + shift) mod n is a bijection of 0..n-1.

    The step is the first number from its start on that has no factor in common with n, small enough
    that the product stays a 64-bit number.
    """
    out = []
    for r in range(1, repeats + 1):
        step = 1 + (r * 2654435761 + seed * 40503) % min(n, (1 << 62) // n)
        while math.gcd(step, n) != 1:
            step += 1
        out.append((step, (r * 40692 + seed) * 48271 % n))
    return out


def dealt_anew(df: DataFrame, features: Sequence[str], key: Sequence[str], repeats: int = 10, seed: int = 42) -> DataFrame:
    """repeat, j, label, x: every row once for each repeat and feature j, with that feature's value of another row.

    Rows are numbered once, in a hash order of ``key``, and a repeat sends each row's values to another
    number by a bijection, so nothing is sorted for a repeat. Runs the job that numbers the rows. An
    empty table stays empty.
    """
    x = df.select(*key, LABEL, F.array(*[F.col(c).cast("double") for c in features]).alias("x"))
    at = materialize(hash_ranked(x, key, (), seed, rank="_i").select((F.col("_i") - 1).alias("_i"), LABEL, "x"), "numbered-rows")
    n = max(at.count(), 1)
    ways = F.array(*[
        F.struct(F.lit(r).alias("repeat"), F.lit(step).cast("long").alias("_step"), F.lit(shift).cast("long").alias("_shift"))
        for r, (step, shift) in enumerate(dealings(n, repeats, seed), 1)
    ])
    sent = at.select(F.col("_i").alias("_from"), F.col("x").alias("donor"), F.inline(ways))
    sent = sent.select("repeat", "donor", F.pmod(F.col("_step") * F.col("_from") + F.col("_shift"), F.lit(n).cast("long")).alias("_i"))
    pairs = sent.join(at, "_i").select("repeat", LABEL, "x", F.posexplode("donor").alias("j", "v"))
    swapped = F.transform("x", lambda e, k: F.when(k == F.col("j"), F.col("v")).otherwise(e))
    return pairs.select("repeat", "j", LABEL, swapped.alias("x"))


def permutation_importance(
    model: PipelineModel | Callable[[Column], Column], df: DataFrame, features: Sequence[str], key: Sequence[str], repeats: int = 10, seed: int = 42
) -> DataFrame:
    """Loss of R2 when one feature's values are dealt out anew among the rows.

    All features and repeats are scored in one job. ``df`` is a ``ready`` table. ``model`` is a fitted
    pipeline that starts with an assembler, or a function from the array of features to the prediction.
    """
    x = df.select(LABEL, F.array(*[F.col(c).cast("double") for c in features]).alias("x"))

    def predicted(rows: DataFrame) -> DataFrame:
        if isinstance(model, PipelineModel):
            return _score_vectors(model, rows.withColumn("x", array_to_vector("x")), "x")
        return rows.withColumn("prediction", model(F.col("x")))

    scored, base = predicted(dealt_anew(df, features, key, repeats, seed)), predicted(x)
    e = F.col(LABEL) - F.col("prediction")
    whole = base.agg(F.struct(F.sum(e * e).alias("sse"), (F.var_pop(LABEL) * F.count(LABEL)).alias("sst"))).scalar()
    per = scored.groupBy("j", "repeat").agg(F.sum(e * e).alias("sse"))
    loss = (F.col("sse") - whole.getField("sse")) / whole.getField("sst")
    names = F.array(*[F.lit(f) for f in features])
    out = per.select(F.get(names, F.col("j")).alias("feature"), loss.alias("loss"))
    return out.groupBy("feature").agg(F.avg("loss").alias("importance"), F.stddev_pop("loss").alias("spread"))


def _score_vectors(model: PipelineModel, rows: DataFrame, vector: str) -> DataFrame:
    """Apply the stages behind the assembler to ready-made vectors."""
    first, *rest = model.stages
    return PipelineModel(stages=rest).transform(rows.withColumnRenamed(vector, first.getOutputCol()))


GEO_CONTINUOUS = ["lat_norm", "lon_norm", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]
GEO_CODES = ["hour", "day_of_week", "month_code", "grid_id"]


def geo_encode(df: DataFrame, cells: DataFrame, ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Eight continuous and four categorical inputs; an unknown cell takes the nearest known one.

    ``ranges`` holds the coordinate bounds of the training samples.
    """
    rows = snap_to_cell(df, cells)
    cols = {
        "lat_norm": encode.minmax(F.col("latitude"), *ranges["latitude"]),
        "lon_norm": encode.minmax(F.col("longitude"), *ranges["longitude"]),
        "month_code": F.col("month") - 1,
        "grid_id": F.coalesce(F.col("grid_id"), F.lit(0)),
        **calendar.cyclical_terms(F.col("hour"), F.col("day_of_week"), F.col("month")),
    }
    return rows.withColumns(cols)


def coordinate_ranges(samples: DataFrame) -> dict[str, tuple[float, float]]:
    """Four numbers to the driver."""
    r = samples.agg(F.min("latitude"), F.max("latitude"), F.min("longitude"), F.max("longitude")).first()
    return {"latitude": (r[0], r[1]), "longitude": (r[2], r[3])}


def train_geo(encoded: DataFrame, trees: bool = False, seed: int = 42) -> PipelineModel:
    """Ticket probability of a cell and hour. Codes are one-hot, so the vectors stay sparse."""
    hot = [f"{c}_hot" for c in GEO_CODES]
    encoder = OneHotEncoder(inputCols=GEO_CODES, outputCols=hot, handleInvalid="keep")
    parts = _assembler([*GEO_CONTINUOUS, *hot])
    if trees:
        model = GBTClassifier(labelCol=LABEL, seed=seed)
        parts = _assembler([*GEO_CONTINUOUS, *GEO_CODES])
        return Pipeline(stages=[parts, model]).fit(encoded)
    model = LogisticRegression(labelCol=LABEL, regParam=1e-4)
    return Pipeline(stages=[encoder, parts, model]).fit(encoded)


def score_geo(model: PipelineModel, encoded: DataFrame) -> DataFrame:
    out = model.transform(encoded)
    return out.withColumn("score", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction", "features", *[f"{c}_hot" for c in GEO_CODES])


def predict_points(
    points: DataFrame, model: PipelineModel | DataFrame, cells: DataFrame, ranges: dict[str, tuple[float, float]], month_mode: Column | int
) -> DataFrame:
    """Ticket probability of points given by coordinates and a time, or by hour, weekday and month.

    ``model`` is a fitted pipeline, or a relation of weights (see ``levels``) that is scored by joins.

    ``points`` has ``latitude``, ``longitude`` and any of ``when``, ``hour``, ``day_of_week``,
    ``month``. A missing month is the usual one. Rows out of range keep a ``reject`` reason and no score.
    """
    mode = month_mode if isinstance(month_mode, Column) else F.lit(month_mode)
    have = set(points.columns)
    when = F.col("when").try_cast("timestamp_ntz") if "when" in have else F.lit(None).cast("timestamp_ntz")

    def part(name: str, from_time: Column) -> Column:
        given = F.col(name).cast("int") if name in have else F.lit(None).cast("int")
        return F.coalesce(from_time, given)

    rows = points.withColumns(
        {
            "hour": part("hour", F.hour(when)),
            "day_of_week": part("day_of_week", F.weekday(when)),
            "month": F.coalesce(part("month", F.month(when)), mode.cast("int")),
        }
    )
    reject = (
        F.when(F.col("latitude").isNull() | F.col("longitude").isNull(), "no coordinates")
        .when(F.col("hour").isNull() | F.col("day_of_week").isNull(), "no time")
        .when(~F.col("hour").between(0, 23), "hour must be in 0..23")
        .when(~F.col("day_of_week").between(0, 6), "weekday must be in 0..6")
        .when(~F.col("month").between(1, 12), "month must be in 1..12")
    )
    rows = rows.withColumn("reject", reject)
    good = rows.where(F.col("reject").isNull()).withColumns(
        {"lat_id": encode.grid_id(F.col("latitude")), "lon_id": encode.grid_id(F.col("longitude"))}
    )
    encoded = geo_encode(good, cells, ranges)
    scored = score_geo(model, encoded) if isinstance(model, PipelineModel) else score_by_weights(encoded, model, GEO_CODES, GEO_CONTINUOUS)
    scored = scored.select(*rows.columns, "grid_id", "score")
    bad = rows.where(F.col("reject").isNotNull())
    return union_by_name(scored, bad)
