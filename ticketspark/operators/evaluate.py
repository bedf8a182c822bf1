"""Forecast evaluation over the long prediction table.

The table has one row per series, target date, horizon, split and model, with ``y_true`` and
``y_pred``. Everything here is grouped sums over it; no group is brought to one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar, metrics
from ..functions.encode import pct_gain, report_round
from ..functions.hashing import hash_bucket, key_hash, mix
from ..session import materialize
from .joins import attach, spread
from .ordering import exact_quantiles, ranked, running_sums
from .windows import rolling

# fixed values: models that count as baselines
BASELINES = ["LinearRegression", "LassoCV", "RandomForest", "GBDT", "SARIMAX(1,1,1)(1,1,1,7)"]

# fixed values: weekday order of the segment report
REPORT_WEEK = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def residuals(preds: DataFrame) -> DataFrame:
    """Both signs of the residual and its size."""
    e = F.col("y_pred") - F.col("y_true")
    return preds.withColumns({"residual": e, "error": -e, "abs_err": F.abs(e)})


def summarize(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MAE, RMSE, MAPE, sMAPE, WAPE and n per group."""
    sums = preds.groupBy(*keys).agg(*metrics.error_sums())
    return sums.select(*keys, *[c.alias(n) for n, c in metrics.finish().items()])


def leaderboards(preds: DataFrame) -> DataFrame:
    """The same measures by model, by split and model, and by horizon, split and model.

    One pass over the predictions to the finest level; the other levels add up its sums.
    """
    keys = ["horizon", "split", "model"]
    fine = preds.groupBy(*keys).agg(*metrics.error_sums())
    levels = [["model"], ["split", "model"], keys]
    rolled = fine.groupingSets(levels, *keys).agg(F.grouping_id().alias("_g"), *metrics.add_up())
    level = F.when(F.col("_g") == 0, "horizon").when(F.col("_g") == 4, "split").otherwise("overall")
    return rolled.select(level.alias("level"), *keys, *[c.alias(n) for n, c in metrics.finish().items()])


def winners(board: DataFrame, by: Sequence[str] = ("horizon",), metric: str = "mae", name: str = "model") -> DataFrame:
    """Row with the smallest error per group, the first name on a tie; an aggregate, so no sort."""
    others = [c for c in board.columns if c not in (*by, metric, name)]
    best = F.min(F.struct(metric, name, *others)).alias("_best")
    return board.groupBy(*by).agg(best).select(*by, "_best.*")


def improvement(board: DataFrame, baselines: Sequence[str] = BASELINES, metric: str = "mae") -> DataFrame:
    """Best baseline against best model per horizon, with absolute and percentage gain."""
    pair = F.struct(metric, "model")
    best = board.groupBy("horizon").agg(
        F.min(F.when(F.col("model").isin(list(baselines)), pair)).alias("_base"), F.min(pair).alias("_best")
    )
    base, top = F.col(f"_base.{metric}"), F.col(f"_best.{metric}")
    return best.where(F.col("_base").isNotNull()).select(
        "horizon",
        F.col("_base.model").alias("best_baseline"),
        report_round(base).alias("best_baseline_mae"),
        F.col("_best.model").alias("best_overall"),
        report_round(top).alias("best_overall_mae"),
        report_round(base - top).alias("abs_improvement"),
        report_round(pct_gain(base, top)).alias("pct_improvement"),
    )


def worst_days(preds: DataFrame, k: int = 10, by: Sequence[str] = ("horizon",), ties: Sequence[str] = ("date",)) -> DataFrame:
    """The k largest absolute errors per group; each task keeps at most k rows before the shuffle."""
    rows = preds.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    rows = rows.withColumn("abs_err", F.abs(F.col("y_true") - F.col("y_pred")))
    w = Window.partitionBy(*by).orderBy(F.desc("abs_err"), *ties)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def calibration_pairs(preds: DataFrame, board: DataFrame) -> DataFrame:
    """Actual and predicted values of the best model of each horizon."""
    best = winners(board).select("horizon", "model")
    return preds.join(best, ["horizon", "model"], "left_semi")


def totals(preds: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    rows = preds.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    return rows.groupBy(*by).agg(F.sum("y_true").alias("total_actual"), F.sum("y_pred").alias("total_predicted"))


def segment_error(preds: DataFrame, part: str, by: Sequence[str] = ("model", "horizon")) -> DataFrame:
    """Mean absolute error by weekday (in report order) or by month."""
    if part == "weekday":
        rows = preds.withColumn("weekday", calendar.weekday_name(F.col("date")))
        extra = {"weekday_order": F.array_position(F.array(*[F.lit(d) for d in REPORT_WEEK]), F.col("weekday")).cast("int")}
    else:
        rows = preds.withColumn("month", F.date_format(F.col("date"), "yyyy-MM"))
        extra = {}
    out = rows.groupBy(*by, part).agg(metrics.mae("y_true", "y_pred").alias("mae"))
    return out.withColumns(extra) if extra else out


def leaderboard_matrix(board: DataFrame, horizons: Sequence[int], metric: str = "mae") -> DataFrame:
    """Models by horizons."""
    cols = [F.avg(F.when(F.col("horizon") == h, F.col(metric))).alias(f"t_plus_{h}") for h in horizons]
    return board.groupBy("model").agg(*cols)


def cv_summary(folds: DataFrame, by: Sequence[str] = ("horizon",), metric: str = "mae") -> DataFrame:
    return folds.groupBy(*by).agg(F.avg(metric).alias(f"{metric}_mean"), F.stddev_samp(metric).alias(f"{metric}_std"))


def rolling_error(preds: DataFrame, by: Sequence[str], n: int = 14, min_periods: int = 5, date: str = "date") -> DataFrame:
    """Rolling mean absolute error along each prediction series."""
    w = Window.partitionBy(*by).orderBy(date)
    err = F.abs(F.col("y_pred") - F.col("y_true"))
    return preds.withColumn("rolling_mae", rolling(err, n, "mean", w, min_periods=min_periods))


def mase(board: DataFrame, scale: Column, metric: str = "mae") -> DataFrame:
    """Error against the mean absolute daily change of the training rows."""
    return board.withColumn("mase", F.col(metric) / F.greatest(scale, F.lit(1e-6)))


def conformal_radius(val: DataFrame, q: float = 0.9, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """The q-quantile of the absolute validation residuals per group."""
    rows = val.select(*by, F.abs(F.col("y_true") - F.col("y_pred")).alias("abs_err"))
    return exact_quantiles(rows, "abs_err", {"alpha": q}, by)


def conformal(val: DataFrame, test: DataFrame, q: float = 0.9, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """Test predictions with a band of validated width."""
    rows = attach(test, conformal_radius(val, q, by), list(by), "inner")
    return rows.withColumns({"lo": F.col("y_pred") - F.col("alpha"), "hi": F.col("y_pred") + F.col("alpha")})


def coverage(bands: DataFrame, nominal: float = 0.9, by: Sequence[str] = ("horizon",)) -> DataFrame:
    """Part of the actual values within their band."""
    inside = F.col("y_true").between(F.col("lo"), F.col("hi")).cast("double")
    out = bands.groupBy(*by).agg(F.avg(inside).alias("empirical"), F.max("alpha").alias("alpha"))
    gap = F.abs(F.col("empirical") - nominal)
    return out.withColumns({"nominal": F.lit(nominal), "coverage_gap": gap})


def fit_scale(val: DataFrame, by: Sequence[str] = ("horizon",), min_rows: int = 5) -> DataFrame:
    """Factor per group that fits the actual values best; one when there are too few rows."""
    x, y = F.col("y_pred").cast("double"), F.col("y_true").cast("double")
    rows = val.where(y.isNotNull() & x.isNotNull())
    fitted = F.sum(x * y) / (F.sum(x * x) + 1e-12)
    return rows.groupBy(*by).agg(F.when(F.count(F.lit(1)) >= min_rows, fitted).otherwise(1.0).alias("scale"))


def apply_scale(preds: DataFrame, scales: DataFrame, by: Sequence[str] = ("horizon",)) -> DataFrame:
    rows = attach(preds, scales, list(by))
    return rows.withColumn("y_pred", F.col("y_pred") * F.coalesce("scale", F.lit(1.0))).drop("scale")


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal bins over the range of the whole table, empty bins included; the last bin is closed.

    At most ``bins`` counts per group exist after the first aggregate, so the rest is small.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    lo, hi = F.min("_v"), F.max("_v")
    flat = lo == hi
    ends = rows.agg(
        F.struct(F.when(flat, lo - 0.5).otherwise(lo).alias("lo"), F.when(flat, hi + 0.5).otherwise(hi).alias("hi"))
    ).scalar()
    lo, width = F.col("_ends.lo"), (F.col("_ends.hi") - F.col("_ends.lo")) / bins
    slot = F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1)).cast("int")
    counts = rows.withColumn("_ends", ends).groupBy(*by, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    packed = counts.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_n"))
    full = packed.select(*by, "_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return full.withColumn("_ends", ends).select(
        *by,
        "bin",
        (lo + F.col("bin") * width).alias("left_edge"),
        F.coalesce(F.try_element_at("_n", F.col("bin")), F.lit(0)).cast("long").alias("n"),
    )


def evaluation_summary(best: DataFrame, gains: DataFrame, cover: DataFrame, cv: DataFrame) -> DataFrame:
    """Winners, gains, coverage and cross-validation side by side; every input has one row per horizon."""
    gains = gains.select("horizon", "best_baseline", "best_baseline_mae", "abs_improvement", "pct_improvement")
    cover = cover.select("horizon", "nominal", "empirical")
    out = best.select(
        "horizon",
        F.col("model").alias("best_overall"),
        F.col("mae").alias("best_mae"),
        F.col("rmse").alias("best_rmse"),
        F.col("mape").alias("best_mape"),
    )
    return out.join(gains, "horizon", "left").join(cover, "horizon", "left").join(cv, "horizon", "left")


# rows whose errors are kept together as one array
BLOCK = 4096


def bootstrap(
    preds: DataFrame, by: Sequence[str], key: Sequence[str], replicates: int = 1000, seed: int = 42, block: int = BLOCK
) -> DataFrame:
    """Resampled MAE and RMSE: per group and replicate, n draws with replacement from its n rows.

    Rows are numbered within their group and cut into blocks. A first draw per row picks a block, and
    only the number of draws per block is shuffled. The draws within a block are then made where its
    errors are. Draws themselves never move, and a large group is spread over its blocks. Null
    predictions are left out. Runs the job that numbers the rows.
    """
    e = (F.col("y_true") - F.col("y_pred")).cast("double")
    rows = preds.select(*by, *key, e.alias("_e")).where(F.col("_e").isNotNull())
    rows = rows.withColumn("_h", key_hash(*[F.col(k) for k in key], seed=seed))
    order = [F.col("_h"), *[F.col(k) for k in key]]
    rows = ranked(rows, by, hash_bucket(F.col("_h")), order, "_i", "_n").withColumn("_block", F.floor((F.col("_i") - 1) / block))
    # written once: the blocks and the draws both start from the numbered errors
    rows = materialize(rows.select(*by, "_i", "_n", "_block", "_e"), "numbered-errors")
    errors = F.transform(F.sort_array(F.collect_list(F.struct("_i", "_e"))), lambda x: x["_e"])
    blocks = rows.groupBy(*by, "_block").agg(errors.alias("_es"))
    slots = spread(rows.select(*by, "_n", (F.col("_i") - 1).alias("_slot")), *by, "_slot")
    first = slots.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    to = F.floor(F.pmod(mix(F.col("_slot"), F.col("replicate"), seed), F.col("_n")) / block)
    counts = first.groupBy(*by, "replicate", to.alias("_block")).agg(F.count(F.lit(1)).alias("_draws"))
    meet = spread(counts, *by, "replicate", "_block").join(blocks, [*by, "_block"])
    draws = meet.withColumn("_j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_draws"))))
    stream = F.col("replicate") * F.lit(1000003).cast("long") + F.col("_block")
    at = F.pmod(mix(F.col("_j"), stream, seed + 1), F.size("_es")).cast("int")
    drawn = draws.select(*by, "replicate", F.get("_es", at).alias("_e"))
    return drawn.groupBy(*by, "replicate").agg(
        F.avg(F.abs("_e")).alias("mae"), F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse")
    )


def bootstrap_ci(
    preds: DataFrame, by: Sequence[str] = ("split", "model", "horizon"), key: Sequence[str] = ("date",),
    replicates: int = 1000, level: float = 0.95, seed: int = 42,
) -> DataFrame:
    """MAE and RMSE with percentile intervals. The quantiles see ``replicates`` values per group."""
    tail = (1.0 - level) / 2
    ends = [tail, 1.0 - tail]
    ci = bootstrap(preds, by, key, replicates, seed).groupBy(*by).agg(
        F.percentile("mae", ends).alias("_mae"), F.percentile("rmse", ends).alias("_rmse")
    )
    point = summarize(preds.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull()), by)
    return point.join(ci, list(by)).select(
        *by,
        "mae",
        F.col("_mae")[0].alias("mae_lo"),
        F.col("_mae")[1].alias("mae_hi"),
        "rmse",
        F.col("_rmse")[0].alias("rmse_lo"),
        F.col("_rmse")[1].alias("rmse_hi"),
        "n",
    )


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, with running totals from the highest score down."""
    per = df.groupBy(F.col(score).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return running_sums(per, "_s", ["pos", "neg"], descending=True)


def ranking_scores(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve and average precision, equal scores taken together."""
    pts = _by_score(df, label, score)
    p, n = F.sum("pos"), F.sum("neg")
    above = F.col("cum_pos") - F.col("pos")
    won = F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
    ap = F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return pts.agg(
        F.try_divide(won, p.cast("double") * n).alias("roc_auc"), F.try_divide(ap, p.cast("double")).alias("average_precision")
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_scores(df, label, score).select("roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_scores(df, label, score).select("average_precision")


def class_report(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support of both classes."""
    yes, hit = F.col(label) == 1, F.col(score) > threshold
    c = df.agg(
        F.count_if(yes & hit).alias("tp"),
        F.count_if(~yes & hit).alias("fp"),
        F.count_if(yes & ~hit).alias("fn"),
        F.count_if(~yes & ~hit).alias("tn"),
    )

    def row(name: int, tp: str, fp: str, fn: str) -> Column:
        tp, fp, fn = F.col(tp), F.col(fp), F.col(fn)
        return F.struct(
            F.lit(name).alias("class"),
            F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
            F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
            F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
            (tp + fn).alias("support"),
        )

    return c.select(F.inline(F.array(row(0, "tn", "fn", "fp"), row(1, "tp", "fp", "fn"))))
