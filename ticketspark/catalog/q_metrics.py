"""Error measures, intervals, calibration and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics
from ..operators import evaluate, reshape, windows
from . import fixtures as fx
from .q_aggregate import _MEASURES
from .registry import query, r6, s6

Y, P = "y_true", "y_pred"


def _test(spark, d):
    return fx.predictions(spark, d).where("split = 'test'")


@query(
    "m1_mae_mse_rmse",
    f"""WITH {fx.PREDS} SELECT model, horizon, {s6("avg(abs(y_true - y_pred))", "mae")}, {s6("avg(power(y_true - y_pred, 2))", "mse")},
  {s6("sqrt(avg(power(y_true - y_pred, 2)))", "rmse")} FROM preds WHERE split = 'test' GROUP BY 1, 2""",
)
def basic(spark, d):
    cols = {"mae": metrics.mae(Y, P), "mse": metrics.mse(Y, P), "rmse": metrics.rmse(Y, P)}
    return _test(spark, d).groupBy("model", "horizon").agg(*[r6(c, n) for n, c in cols.items()])


_E = "abs(y_true - y_pred)"
_MAPE = {
    "floor1": f"avg({_E} / greatest(y_true, 1)) * 100",
    "abs_floor1": f"avg({_E} / greatest(abs(y_true), 1)) * 100",
    "abs_eps": f"avg({_E} / (abs(y_true) + 1e-8)) * 100",
    "skip_zero": f"avg(CASE WHEN abs(y_true) > 1e-8 THEN {_E} / abs(y_true) END) * 100",
    "plus_eps": "avg(abs((y_true - y_pred) / (y_true + 1e-8))) * 100",
}


def _busy(expr: str) -> str:
    """Days without tickets make the eps kinds huge; they are compared in log space."""
    return f"ln(1 + {expr})"


@query(
    "m2_mape_kinds",
    f"""WITH {fx.PREDS} SELECT model, horizon, {", ".join(s6(_busy(e), k) for k, e in _MAPE.items())} FROM preds WHERE split = 'test' GROUP BY 1, 2""",
)
def mape_kinds(spark, d):
    return _test(spark, d).groupBy("model", "horizon").agg(*[r6(F.log1p(metrics.mape(Y, P, k)), k) for k in _MAPE])


@query(
    "m3_smape_kinds",
    f"""WITH {fx.PREDS} SELECT model, horizon, {s6(f"avg(200 * {_E} / (abs(y_true) + abs(y_pred) + 1e-8))", "smape_sum")},
  {s6(f"avg({_E} / greatest((abs(y_true) + abs(y_pred)) / 2, 1e-8)) * 100", "smape_half")} FROM preds WHERE split = 'test' GROUP BY 1, 2""",
)
def smape_kinds(spark, d):
    cols = [r6(metrics.smape(Y, P, "sum"), "smape_sum"), r6(metrics.smape(Y, P, "half"), "smape_half")]
    return _test(spark, d).groupBy("model", "horizon").agg(*cols)


@query(
    "m4_wape",
    f"""WITH {fx.PREDS} SELECT model, horizon, {s6(f"sum({_E}) / (sum(abs(y_true)) + 1e-8) * 100", "wape")} FROM preds WHERE split = 'test' GROUP BY 1, 2""",
)
def wape(spark, d):
    return _test(spark, d).groupBy("model", "horizon").agg(r6(metrics.wape(Y, P), "wape"))


@query(
    "m5_r2",
    f"""WITH {fx.PREDS} SELECT model, horizon, {s6("1 - sum(power(y_true - y_pred, 2)) / (var_pop(y_true) * count(*))", "r2")}
FROM preds WHERE split = 'test' GROUP BY 1, 2""",
)
def r2(spark, d):
    return _test(spark, d).groupBy("model", "horizon").agg(r6(metrics.r2(Y, P), "r2"))


@query(
    "m6_log_errors",
    f"""WITH {fx.PREDS} SELECT model, horizon, {s6("sqrt(avg(power(ln(1 + greatest(y_true, 0)) - ln(1 + y_pred), 2)))", "rmse_log")},
  {s6("avg(abs(ln(1 + greatest(y_true, 0)) - ln(1 + y_pred)))", "mae_log")} FROM preds WHERE split = 'test' GROUP BY 1, 2""",
)
def log_errors(spark, d):
    q = F.log1p(P)
    cols = [r6(metrics.log_rmse(Y, q), "rmse_log"), r6(metrics.log_mae(Y, q), "mae_log")]
    return _test(spark, d).groupBy("model", "horizon").agg(*cols)


@query(
    "m7_mase",
    f"""WITH {fx.PREDS}, {fx.BOARD},
city AS (SELECT date, sum(num_violations) AS y FROM daily GROUP BY 1),
st AS (SELECT abs(y - lag(y) OVER (ORDER BY date)) AS step FROM city WHERE date <= DATE '1999-12-31'),
sc AS (SELECT avg(step) AS scale FROM st)
SELECT horizon, model, {s6("mae", "mae")}, {s6("mae / greatest(scale, 1e-6)", "mase")} FROM board, sc""",
)
def mase(spark, d):
    city = fx.daily(spark, d).groupBy("date").agg(F.sum("num_violations").alias("y")).withColumn("series_id", F.lit("city"))
    scale = windows.naive_scale(city, "y", F.col("date") <= F.lit(fx.TRAIN_END).cast("date")).select("naive_scale").scalar()
    x = evaluate.mase(evaluate.summarize(_test(spark, d), ["horizon", "model"]), scale)
    return x.select("horizon", "model", r6("mae", "mae"), r6("mase", "mase"))


_W = "CASE horizon WHEN 1 THEN 1.3 WHEN 3 THEN 1.1 ELSE 1.0 END"


@query(
    "m8_masked_losses",
    f"""WITH {fx.PREDS}, p AS (SELECT model, horizon, CASE WHEN day(date) % 5 <> 0 THEN y_true END AS y_true, y_pred FROM preds WHERE split = 'test')
SELECT model, {s6("sqrt(sum(CASE WHEN y_true IS NOT NULL THEN power(y_true - y_pred, 2) ELSE 0 END) / (count(y_true) + 1e-8))", "masked_rmse")},
  {s6(f"sum(CASE WHEN y_true IS NOT NULL THEN {_W} * CASE WHEN {_E} < 0.2 THEN 0.5 * {_E} * {_E} / 0.2 ELSE {_E} - 0.1 END ELSE 0 END) / (sum(CASE WHEN y_true IS NOT NULL THEN {_W} ELSE 0 END) + 1e-8)", "smooth_l1")}
FROM p GROUP BY model""",
)
def masked(spark, d):
    p = _test(spark, d).withColumn("y_true", F.when(F.dayofmonth("date") % 5 != 0, F.col(Y)))
    return p.groupBy("model").agg(r6(metrics.masked_rmse(Y, P), "masked_rmse"), r6(metrics.smooth_l1(Y, P, F.col("horizon")), "smooth_l1"))


@query("m9_metrics_by_group", f"WITH {fx.PREDS} SELECT series_id, split, horizon, model, {_MEASURES} FROM preds GROUP BY 1, 2, 3, 4")
def by_group(spark, d):
    x = evaluate.summarize(fx.predictions(spark, d), ["series_id", "split", "horizon", "model"])
    return x.select("series_id", "split", "horizon", "model", *[r6(m, m) for m in ("mae", "rmse", "mape", "smape", "wape")], "n")


@query(
    "m10_improvement",
    f"""WITH {fx.PREDS}, {fx.BOARD},
a AS (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY mae, model) AS rn FROM board),
b AS (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY mae, model) AS rn FROM board WHERE model IN ('last', 'seasonal'))
SELECT a.horizon, b.model AS best_baseline, round_even((b.mae) * 100, 0) / 100 AS best_baseline_mae, a.model AS best_overall, round_even((a.mae) * 100, 0) / 100 AS best_overall_mae,
  round_even((b.mae - a.mae) * 100, 0) / 100 AS abs_improvement, round_even((b.mae - a.mae) / b.mae * 100 * 100, 0) / 100 AS pct_improvement
FROM a JOIN b ON a.horizon = b.horizon AND a.rn = 1 AND b.rn = 1""",
)
def improvement(spark, d):
    return evaluate.improvement(evaluate.summarize(_test(spark, d), ["horizon", "model"]), ["last", "seasonal"])


_BANDS = fx.PREDS + """,
alpha AS (SELECT model, horizon, quantile_cont(abs(y_true - y_pred), 0.9) AS alpha FROM preds WHERE split = 'val' GROUP BY 1, 2),
bands AS (SELECT p.*, a.alpha, y_pred - alpha AS lo, y_pred + alpha AS hi FROM preds p JOIN alpha a ON p.model = a.model AND p.horizon = a.horizon WHERE split = 'test')"""


def _bands(spark, d):
    p = fx.predictions(spark, d)
    return evaluate.conformal(p.where("split = 'val'"), p.where("split = 'test'"), 0.9, ["model", "horizon"])


@query(
    "m11_conformal_band",
    f"WITH {_BANDS} SELECT series_id, date, model, horizon, {s6('alpha', 'alpha')}, {s6('lo', 'lo')}, {s6('hi', 'hi')} FROM bands",
)
def conformal(spark, d):
    return _bands(spark, d).select("series_id", "date", "model", "horizon", r6("alpha", "alpha"), r6("lo", "lo"), r6("hi", "hi"))


@query(
    "m12_coverage",
    f"""WITH {_BANDS} SELECT model, horizon, {s6("avg(CASE WHEN y_true BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END)", "empirical")}, {s6("max(alpha)", "alpha")},
  CAST(0.9 AS DOUBLE) AS nominal, {s6("abs(avg(CASE WHEN y_true BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END) - 0.9)", "coverage_gap")} FROM bands GROUP BY 1, 2""",
)
def coverage(spark, d):
    x = evaluate.coverage(_bands(spark, d), by=["model", "horizon"])
    return x.select("model", "horizon", r6("empirical", "empirical"), r6("alpha", "alpha"), "nominal", r6("coverage_gap", "coverage_gap"))


@query(
    "m13_scale_calibration",
    f"""WITH {fx.PREDS}, s AS (SELECT model, horizon, CASE WHEN count(*) >= 5 THEN sum(y_pred * y_true) / (sum(y_pred * y_pred) + 1e-12) ELSE 1 END AS a
  FROM preds WHERE split = 'val' GROUP BY 1, 2)
SELECT p.series_id, p.date, p.model, p.horizon, {s6("y_pred * a", "y_pred")} FROM preds p JOIN s ON p.model = s.model AND p.horizon = s.horizon WHERE split = 'test'""",
)
def scale(spark, d):
    p = fx.predictions(spark, d)
    keys = ["model", "horizon"]
    scales = evaluate.fit_scale(p.where("split = 'val'"), keys)
    x = evaluate.apply_scale(p.where("split = 'test'"), scales, keys)
    return x.select("series_id", "date", "model", "horizon", r6("y_pred", "y_pred"))


_SCORED = """scored AS (SELECT event_id, CAST(event_type IN ('purchase', 'error') AS INTEGER) AS label,
  (event_id * 7919 % 97 + CASE WHEN event_type = 'purchase' THEN 20 ELSE 0 END) / CAST(120 AS DOUBLE) AS score FROM events)"""


def _scored(spark, d):
    e = fx.table(spark, d, "events")
    bump = F.when(F.col("event_type") == "purchase", 20).otherwise(0)
    return e.select(
        F.col("event_type").isin("purchase", "error").cast("int").alias("label"),
        ((F.col("event_id") * 7919 % 97 + bump) / F.lit(120.0)).alias("score"),
    )


@query(
    "m15_auc_and_average_precision",
    f"""WITH {_SCORED}, g AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(neg) OVER (ORDER BY score DESC) AS cn FROM g)
SELECT {s6("sum(neg * (cp - pos + pos / 2)) / (sum(pos) * CAST(sum(neg) AS DOUBLE))", "roc_auc")},
  {s6("sum(pos * cp / (cp + cn)) / sum(pos)", "average_precision")} FROM c""",
)
def auc(spark, d):
    x = evaluate.ranking_scores(_scored(spark, d))
    return x.select(r6("roc_auc", "roc_auc"), r6("average_precision", "average_precision"))


_PRICE = """priced AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_extendedprice * (1 - l_discount) AS score FROM lineitem)"""


@query(
    "m15_auc_continuous_scores",
    f"""WITH {_PRICE}, g AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM priced GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(neg) OVER (ORDER BY score DESC) AS cn FROM g)
SELECT {s6("sum(neg * (cp - pos + pos / 2)) / (sum(pos) * CAST(sum(neg) AS DOUBLE))", "roc_auc")},
  {s6("sum(pos * cp / (cp + cn)) / sum(pos)", "average_precision")} FROM c""",
)
def auc_continuous(spark, d):
    t = fx.table(spark, d, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("score")
    )
    x = evaluate.ranking_scores(t)
    return x.select(r6("roc_auc", "roc_auc"), r6("average_precision", "average_precision"))


def _class(name: int, hit: str, wrong: str, missed: str) -> str:
    return f"""SELECT {name} AS class, {s6(f"{hit} / ({hit} + {wrong})", "precision")}, {s6(f"{hit} / ({hit} + {missed})", "recall")},
  {s6(f"2 * {hit} / (2 * {hit} + {wrong} + {missed})", "f1")}, CAST({hit} + {missed} AS BIGINT) AS support FROM c"""


@query(
    "m16_classification_report",
    f"""WITH {_SCORED}, c AS (SELECT count(*) FILTER (WHERE label = 1 AND score > 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND score > 0.5) AS fp,
  count(*) FILTER (WHERE label = 1 AND score <= 0.5) AS fn, count(*) FILTER (WHERE label = 0 AND score <= 0.5) AS tn FROM scored)
{_class(0, "tn", "fn", "fp")} UNION ALL {_class(1, "tp", "fp", "fn")}""",
)
def class_report(spark, d):
    x = evaluate.class_report(_scored(spark, d))
    return x.select("class", r6("precision", "precision"), r6("recall", "recall"), r6("f1", "f1"), "support")


@query(
    "m17_calibration_pairs",
    f"""WITH {fx.PREDS}, {fx.BOARD}, b AS (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY mae, model) AS rn FROM board)
SELECT p.series_id, p.date, p.horizon, p.model, p.y_true, {s6("p.y_pred", "y_pred")} FROM preds p JOIN b ON p.horizon = b.horizon AND p.model = b.model AND rn = 1
WHERE split = 'test'""",
)
def pairs(spark, d):
    p = _test(spark, d)
    x = evaluate.calibration_pairs(p, evaluate.summarize(p, ["horizon", "model"]))
    return x.select("series_id", "date", "horizon", "model", "y_true", r6("y_pred", "y_pred"))


@query(
    "m18_rolling_error_curve",
    f"""WITH {fx.PREDS}, e AS (SELECT series_id, date, horizon, model, abs(y_pred - y_true) AS e FROM preds WHERE split = 'test')
SELECT series_id, date, horizon, model, {s6("CASE WHEN count(e) OVER w >= 5 THEN avg(e) OVER w END", "rolling_mae")} FROM e
WINDOW w AS (PARTITION BY series_id, horizon, model ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
)
def rolling_curve(spark, d):
    x = evaluate.rolling_error(_test(spark, d), ["series_id", "horizon", "model"])
    return x.select("series_id", "date", "horizon", "model", r6("rolling_mae", "rolling_mae"))


@query(
    "m20_ensemble_mean",
    f"WITH {fx.PREDS} SELECT series_id, date, horizon, {s6('avg(y_pred)', 'y_pred')} FROM preds GROUP BY 1, 2, 3",
)
def ensemble(spark, d):
    x = reshape.ensemble_mean(fx.predictions(spark, d), ["series_id", "date", "horizon"])
    return x.select("series_id", "date", "horizon", r6("y_pred", "y_pred"))


@query(
    "d16_fold_summary",
    f"""WITH {fx.PREDS}, f AS (SELECT year(date) AS fold, horizon, avg(abs(y_true - y_pred)) AS mae FROM preds WHERE model = 'mean7' GROUP BY 1, 2)
SELECT horizon, {s6("avg(mae)", "mae_mean")}, {s6("stddev_samp(mae)", "mae_std")} FROM f GROUP BY 1""",
)
def fold_summary(spark, d):
    p = fx.predictions(spark, d).where("model = 'mean7'").withColumn("fold", F.year("date"))
    x = evaluate.cv_summary(evaluate.summarize(p, ["fold", "horizon"]))
    return x.select("horizon", r6("mae_mean", "mae_mean"), r6("mae_std", "mae_std"))
