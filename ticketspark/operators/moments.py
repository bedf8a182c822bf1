"""Linear models from mergeable moments.

Least squares and the lasso need of the rows only sums of products. One aggregate gives them for every
group at once (a series, a fold, a stretch of dates), groups are added where fits need several, and all
fits are solved together. No fit reads the rows, and nothing is iterated over them.

Sums are taken of values less a constant near their mean (``centers``), which does not change a fit and
keeps the differences of sums exact enough.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import target_date
from ..session import materialize
from .joins import attach
from .windows import HORIZONS

#: A feature of which the others leave less than this share of its variance gets no weight.
COLLINEAR = 1e-9


@dataclass(frozen=True)
class LinearModel:
    """Intercept and one weight a feature; ``penalty`` of the lasso that chose them."""

    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]
    penalty: float = 0.0

    def predict(self, values: Mapping[str, Column] | None = None) -> Column:
        """The prediction from columns of the features' names, or from ``values``."""
        values = values or {f: F.col(f) for f in self.features}
        terms = (values[f].cast("double") * F.lit(w) for f, w in zip(self.features, self.weights) if w)
        return reduce(Column.__add__, terms, F.lit(self.intercept))


def centers(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Mean of each column: as many numbers to the driver as columns."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: float(row[i] or 0.0) for i, c in enumerate(columns)}


def _names(p: int, t: int) -> list[str]:
    pairs = [f"xx_{i}_{j}" for i in range(p) for j in range(i, p)]
    return ["n", *[f"x_{i}" for i in range(p)], *pairs, *[f"{s}_{k}" for k in range(t) for s in ("y", "yy")], *[f"xy_{i}_{k}" for i in range(p) for k in range(t)]]


def moments(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], by: Sequence[str] = (), center: Mapping[str, float] | None = None
) -> DataFrame:
    """Per group the number of rows and the sums of values and of products of two values.

    Rows with a null feature or target are left out. Partial sums are made where the rows are, so a group
    that holds most rows is one row a task in the shuffle.
    """
    center = center or {}
    p, t = len(features), len(targets)
    value = {c: F.col(c).cast("double") - F.lit(float(center.get(c, 0.0))) for c in [*features, *targets]}
    rows = df.select(*by, *[value[c].alias(f"v{i}") for i, c in enumerate([*features, *targets])]).dropna(subset=[f"v{i}" for i in range(p + t)])
    v = [F.col(f"v{i}") for i in range(p + t)]
    sums = {"n": F.count(F.lit(1)).cast("double")}
    sums |= {f"x_{i}": F.sum(v[i]) for i in range(p)}
    sums |= {f"xx_{i}_{j}": F.sum(v[i] * v[j]) for i in range(p) for j in range(i, p)}
    for k in range(t):
        y = v[p + k]
        sums |= {f"y_{k}": F.sum(y), f"yy_{k}": F.sum(y * y)} | {f"xy_{i}_{k}": F.sum(v[i] * y) for i in range(p)}
    return rows.groupBy(*by).agg(*[sums[name].alias(name) for name in _names(p, t)])


def added_up(df: DataFrame, features: Sequence[str], targets: Sequence[str], by: Sequence[str], order: str) -> DataFrame:
    """Running totals of moments along ``order``: row k holds the moments of all rows up to it."""
    w = Window.partitionBy(*by).orderBy(order) if by else Window.orderBy(order)
    return df.withColumns({name: F.sum(name).over(w) for name in _names(len(features), len(targets))})


def _swept(augmented: Column, p: int) -> Column:
    """Gauss-Jordan elimination of p unknowns in an array of rows; unknowns without a pivot become 0."""

    def step(m: Column, k: Column) -> Column:
        pivot = F.get(F.get(m, k), k)

        def row(r: Column, i: Column) -> Column:
            scaled = F.transform(r, lambda x: F.when(pivot > COLLINEAR, x / pivot).otherwise(F.lit(0.0)))
            rest = F.zip_with(r, F.get(m, k), lambda x, y: F.when(pivot > COLLINEAR, x - F.get(r, k) * y / pivot).otherwise(x))
            return F.when(i == k, scaled).otherwise(rest)

        return F.transform(m, row)

    return F.aggregate(F.sequence(F.lit(0), F.lit(p - 1)), augmented, step)


def solve(
    sums: DataFrame, features: Sequence[str], targets: Sequence[str], by: Sequence[str] = (), center: Mapping[str, float] | None = None
) -> DataFrame:
    """Least squares of every group and target: by, target (position in ``targets``), n, intercept, weights.

    The normal equations of all groups are solved in one projection, each on the scale of correlations.
    A constant feature, or one that those before it determine, gets no weight. A group without rows has no fit.
    """
    center = center or {}
    p, t = len(features), len(targets)

    names = _names(p, t)
    # a row a group, written once: the sums are used in many places below
    rows = materialize(sums.select(*by, "n", F.array(*names).alias("_m")), "moments").where("n > 0")
    at = {name: i for i, name in enumerate(names)}
    mean = lambda name, i: F.get("_m", i + at[name]) / F.col("n")

    def product(i: Column, j: Column) -> Column:
        a, b = F.least(i, j), F.greatest(i, j)
        return F.get("_m", (at["xx_0_0"] + a * p - a * (a - 1) / 2 + b - a).cast("int")) / F.col("n")

    every, each = F.sequence(F.lit(0), F.lit(p - 1)), F.sequence(F.lit(0), F.lit(t - 1))
    covs = F.transform(every, lambda i: F.transform(every, lambda j: product(i, j) - mean("x_0", i) * mean("x_0", j)))
    cross = F.transform(every, lambda i: F.transform(each, lambda k: mean("xy_0_0", i * t + k) - mean("x_0", i) * mean("y_0", 2 * k)))
    shift = [F.array(*[F.lit(float(center.get(c, 0.0))) for c in part]) for part in (features, targets)]
    rows = rows.select(
        *by, F.col("n").cast("long").alias("n"), covs.alias("_c"), cross.alias("_r"),
        F.transform(every, lambda i: mean("x_0", i) + F.get(shift[0], i)).alias("_mx"), F.transform(each, lambda k: mean("y_0", 2 * k) + F.get(shift[1], k)).alias("_my"),
    )
    rows = rows.withColumn("_s", F.transform("_c", lambda r, i: F.sqrt(F.greatest(F.get(r, i), F.lit(0.0)))))
    # a spread that is rounding alone is none
    rows = rows.withColumn("_s", F.zip_with("_s", "_mx", lambda s, m: F.when(s > 1e-10 * F.abs(m), s).otherwise(F.lit(0.0))))
    over = lambda x, s: F.when(s > 0, x / s).otherwise(F.lit(0.0))
    scaled = F.transform("_c", lambda r, i: F.transform(r, lambda x, j: over(x, F.get("_s", i) * F.get("_s", j))))
    right = F.transform("_r", lambda r, i: F.transform(r, lambda x: over(x, F.get("_s", i))))
    rows = rows.select(*by, "n", "_s", "_mx", "_my", F.zip_with(scaled, right, lambda a, b: F.concat(a, b)).alias("_m"))
    rows = materialize(rows, "normal-equations").withColumn("_m", _swept(F.col("_m"), p))
    fits = F.transform(
        F.sequence(F.lit(0), F.lit(t - 1)),
        lambda k: F.struct(k.alias("target"), F.transform("_m", lambda r, i: over(F.get(r, k + p), F.get("_s", i))).alias("weights")),
    )
    out = rows.select(*by, "n", F.inline(fits), "_mx", "_my")
    return out.select(*by, "target", "n", (F.get("_my", F.col("target")) - dot(F.col("weights"), F.col("_mx"))).alias("intercept"), "weights")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda s, x: s + x)


def fit_linear(df: DataFrame, features: Sequence[str], targets: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Least squares of every target in every group, from one pass for the centers and one for the moments."""
    center = centers(df, [*features, *targets])
    return solve(moments(df, features, targets, by, center), features, targets, by, center)


def predict_all(
    df: DataFrame, fits: DataFrame, features: Sequence[str], targets: Sequence[str], by: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """keep, target, y_true and y_pred of each row under every target's fit of its group."""
    each = fits.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("target", "intercept", "weights"))).alias("_fits"))
    rows = df.withColumns({"_x": F.array(*[F.col(f).cast("double") for f in features]), "_y": F.array(*[F.col(c).cast("double") for c in targets])})
    rows = attach(rows, each, list(by), "inner") if by else rows.withColumn("_fits", each.select("_fits").scalar())
    guess = lambda f: f["intercept"] + dot(f["weights"], F.col("_x"))
    found = F.transform("_fits", lambda f: F.struct(f["target"].alias("target"), F.get("_y", f["target"]).alias("y_true"), guess(f).alias("y_pred")))
    return rows.select(*dict.fromkeys([*by, *keep]), F.inline(found))


def train_linear(
    supervised: DataFrame, features: Sequence[str], horizons: Sequence[int] = HORIZONS, by: Sequence[str] = (), keys: Sequence[str] = ("series_id",),
    prefix: str = "y_t_plus", name: str = "LinearRegression",
) -> tuple[DataFrame, DataFrame]:
    """Long predictions of all rows after the train split, for every horizon, and the fits behind them.

    ``by`` fits each group (a series) for itself. Predictions carry the date they are for.
    """
    targets = [f"{prefix}_{h}" for h in horizons]
    fits = fit_linear(supervised.where("split = 'train'"), features, targets, by)
    found = predict_all(supervised.where("split <> 'train'"), fits, features, targets, by, [*keys, "date", "split"])
    horizon = F.get(F.array(*[F.lit(h) for h in horizons]), F.col("target"))
    preds = found.withColumns({"horizon": horizon, "model": F.lit(name)}).withColumn("date", target_date(F.col("date"), F.col("horizon")))
    return preds.drop("target"), fits


def backtest_linear(
    supervised: DataFrame, features: Sequence[str], horizons: Sequence[int] = HORIZONS, k: int = 3, warmup: int = 365, tail: int = 90,
    prefix: str = "y_t_plus", date: str = "date",
) -> DataFrame:
    """fold, horizon, mae and rmse of least squares refitted at k rolling origins, as ``splits.rolling_origin`` places them.

    Rows are dealt to the stretches between cutoffs and never copied: the moments up to a cutoff are the
    running total of the stretches, and each row is scored by the folds whose cutoff it lies after.
    """
    targets = [f"{prefix}_{h}" for h in horizons]
    rows = supervised.dropna(subset=[*features, *targets])
    center = centers(rows, [*features, *targets])
    ends = rows.agg(F.date_add(F.min(date), warmup).alias("lo"), F.date_sub(F.max(date), tail).alias("hi"))
    days = F.date_diff("hi", "lo")
    cutoffs = ends.select(F.array(*[F.date_add("lo", F.floor(days * F.lit(i) / F.lit(k)).cast("int")) for i in range(1, k + 1)])).scalar()
    # stretch 1 is trained on by every fold, stretch k + 1 by none
    rows = rows.withColumn("_cuts", cutoffs).withColumn("fold", 1 + F.size(F.filter("_cuts", lambda c: c < F.col(date))))
    stretches = moments(rows, features, targets, ["fold"], center)
    every = rows.sparkSession.range(1, k + 1).select(F.col("id").cast("int").alias("fold"))
    # a stretch without rows adds nothing, so its fold has the fit of the one before
    totals = added_up(every.join(stretches, "fold", "left").na.fill(0.0), features, targets, (), "fold")
    fits = solve(totals, features, targets, ["fold"], center)
    listed = fits.select(F.collect_list(F.struct("fold", "target", "intercept", "weights"))).scalar()
    rows = rows.select(
        F.col("fold").alias("_stretch"), F.array(*[F.col(f).cast("double") for f in features]).alias("_x"),
        F.array(*[F.col(c).cast("double") for c in targets]).alias("_y"), listed.alias("_fits"),
    )
    error = lambda f: F.get("_y", f["target"]) - f["intercept"] - dot(f["weights"], F.col("_x"))
    met = F.transform(F.filter("_fits", lambda f: f["fold"] < F.col("_stretch")), lambda f: F.struct(f["fold"].alias("fold"), f["target"].alias("target"), error(f).alias("e")))
    scored = rows.select(F.inline(met)).groupBy("fold", "target").agg(F.avg(F.abs("e")).alias("mae"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"))
    horizon = F.get(F.array(*[F.lit(h) for h in horizons]), F.col("target")).alias("horizon")
    return scored.select("fold", horizon, "mae", "rmse")


def _matrices(row, p: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, float, float]:
    """n, sums, products and the target's parts of one row of moments with one target."""
    xx = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            xx[i, j] = xx[j, i] = row[f"xx_{i}_{j}"]
    return row["n"], np.array([row[f"x_{i}"] for i in range(p)]), xx, np.array([row[f"xy_{i}_0"] for i in range(p)]), row["y_0"], row["yy_0"]


def _centered(parts: Sequence[tuple]) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Means and covariances of the rows of several parts together."""
    n, x, xx, xy, y = (sum(part[i] for part in parts) for i in range(5))
    return x / n, y / n, xx / n - np.outer(x, x) / n**2, xy / n - x * y / n**2


def lasso_weights(cov: np.ndarray, cross: np.ndarray, penalty: float, start: np.ndarray, rounds: int = 10_000, tol: float = 1e-12) -> np.ndarray:
    """Coordinate descent on 1/2 w'Cw - c'w + penalty * sum |w|, from covariances alone."""
    w = start.copy()
    for _ in range(rounds):
        moved = 0.0
        for i in np.flatnonzero(np.diag(cov) > 0):
            pull = cross[i] - cov[i] @ w + cov[i, i] * w[i]
            new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / cov[i, i]
            moved, w[i] = max(moved, abs(new - w[i]) * np.sqrt(cov[i, i])), new
        if moved <= tol:
            break
    return w


def lasso_from_moments(
    df: DataFrame, features: Sequence[str], target: str, fold: str, penalties: int = 100, ratio: float = 1e-3
) -> tuple[LinearModel, list[tuple[float, float]]]:
    """Lasso on standardised features; the penalty has the least mean squared error over the folds in ``fold``.

    Penalties fall evenly in logs from the one that empties the model to ``ratio`` of it. Each fold is
    left out by subtracting its moments, so one pass over the rows serves all fits. The driver receives
    one row of (p + 2)^2 / 2 sums for each fold. Also returned: each penalty and its error.
    """
    p = len(features)
    center = centers(df, [*features, target])
    rows = moments(df, features, [target], [fold], center).collect()
    if not rows:
        raise ValueError("no complete rows to fit")
    folds = [_matrices(row, p) for row in sorted(rows, key=lambda r: r[fold])]
    mean_x, mean_y, cov, cross = _centered(folds)
    shift = np.array([center[f] for f in features])
    spread = np.sqrt(np.clip(np.diag(cov), 0, None))
    scale = np.where(spread > 1e-10 * np.abs(mean_x + shift), spread, np.inf)

    def standard(parts):
        mx, my, c, r = _centered(parts)
        return mx / scale, my, c / np.outer(scale, scale), r / scale

    _, _, cov, cross = standard(folds)
    top = float(np.abs(cross).max(initial=0.0)) or 1.0
    grid = [top * ratio ** (i / max(1, penalties - 1)) for i in range(penalties)]
    errors = np.zeros(penalties)
    for i, held in enumerate(folds):
        others = folds[:i] + folds[i + 1 :] or folds
        mx, my, c, r = standard(others)
        n, x, xx, xy, y, yy = held
        x, xx, xy = x / scale, xx / np.outer(scale, scale), xy / scale
        w = np.zeros(p)
        for a, penalty in enumerate(grid):
            w = lasso_weights(c, r, penalty, w)
            b = my - w @ mx
            errors[a] += (yy - 2 * b * y - 2 * w @ xy + n * b * b + 2 * b * (w @ x) + w @ xx @ w) / n / len(folds)
    best = int(np.argmin(errors))
    w = np.zeros(p)
    for penalty in grid[: best + 1]:
        w = lasso_weights(cov, cross, penalty, w)
    weights = w / scale
    intercept = mean_y + center[target] - float(weights @ (mean_x + shift))
    return LinearModel(tuple(features), intercept, tuple(weights.tolist()), grid[best]), list(zip(grid, errors.tolist()))


def optimality(df: DataFrame, model: LinearModel, target: str) -> DataFrame:
    """feature, weight, pull and optimal: the lasso's conditions, checked on the rows themselves.

    The pull of a feature is the mean product of its standardised value and the residual. It must equal
    the penalty with the weight's sign, or lie within the penalty where the weight is 0.
    """
    e = F.col(target).cast("double") - model.predict()
    rows = df.select(e.alias("_e"), *[F.col(f).cast("double").alias(f"v{i}") for i, f in enumerate(model.features)]).dropna()
    spread = [F.stddev_pop(f"v{i}") for i in range(len(model.features))]
    pulls = rows.agg(*[F.when(s > 0, F.covar_pop(f"v{i}", "_e") / s).otherwise(F.lit(0.0)).alias(f"g{i}") for i, s in enumerate(spread)], F.stddev_pop("_e").alias("_s"))
    tol = 1e-6 * F.greatest(F.col("_s"), F.lit(1.0))
    found = []
    for i, (f, w) in enumerate(zip(model.features, model.weights)):
        g = F.col(f"g{i}")
        fine = F.abs(g - F.lit(model.penalty if w > 0 else -model.penalty)) <= tol if w else F.abs(g) <= model.penalty + tol
        found.append(F.struct(F.lit(f).alias("feature"), F.lit(float(w)).alias("weight"), g.alias("pull"), fine.alias("optimal")))
    return pulls.select(F.inline(F.array(*found)))
