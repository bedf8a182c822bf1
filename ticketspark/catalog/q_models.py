"""Fitted models; checked by rows, except where the data step has exact SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar
from ..operators import aggregate, densify, evaluate, forward, models, moments
from ..plans import cells as cell_plan
from ..plans import daily as daily_plan
from ..plans import tickets as ticket_plan
from ..session import materialize
from . import fixtures as fx
from .registry import query, r6, s6

KEYS = ["series_id", "date"]


def _supervised(spark, d):
    features = daily_plan.with_features(aggregate.daily_counts(fx.tickets(spark, d).withColumnRenamed("agency", "series_id"), "date", ["series_id"]))
    rows = daily_plan.supervised(features, fx.TRAIN_END, fx.VAL_END)
    return materialize(rows, "supervised"), daily_plan.feature_columns(rows)


def _board(spark, d, fits, horizons=(1, 3, 7)):
    rows, features = _supervised(spark, d)
    preds, fitted = models.train_all(rows, fits, features, horizons)
    return evaluate.summarize(preds.where("split = 'test'"), ["model", "horizon"]), fitted, rows, features


@query("l1_linear_regression")
def linear(spark, d):
    return _board(spark, d, {"LinearRegression": models.linear})[0]


def _lasso(rows, features):
    train = models.contiguous_folds(rows.where("split = 'train'").dropna(subset=features), 5)
    return moments.lasso_from_moments(train, features, "y_t_plus_1", "fold")[0]


@query("l2_lasso_cv")
def lasso(spark, d):
    """A hundred penalties over five contiguous folds from one pass of moments, scored on the test rows."""
    rows, features = _supervised(spark, d)
    test = rows.where("split = 'test'").withColumns({"model": F.lit("LassoCV"), "horizon": F.lit(1)})
    preds = test.select("model", "horizon", F.col("y_t_plus_1").cast("double").alias("y_true"), _lasso(rows, features).predict().alias("y_pred"))
    return evaluate.summarize(preds, ["model", "horizon"])


@query("l3_random_forest_importances")
def forest(spark, d):
    _, fitted, rows, features = _board(spark, d, {"RandomForest": models.forest(100)}, [1])
    return models.importances(fitted["RandomForest", 1], rows, features)


@query("l4_gradient_boosted_trees")
def gbt(spark, d):
    return _board(spark, d, {"GBDT": models.gbt(20), "GBDT-early-stop": models.gbt_early_stop(20)}, [1])[0]


@query("l5_train_models_by_horizon")
def train_all(spark, d):
    fits = {"LinearRegression": models.linear, "RandomForest": models.forest(20), "GBDT": models.gbt(5)}
    return _board(spark, d, fits)[0]


@query("l6_forecast_future_days")
def forecast(spark, d):
    t = fx.tickets(spark, d).withColumn("issue_date", F.col("issue_ts").cast("string"))
    matrix = materialize(ticket_plan.daily_matrix(t, "agency", "violation"), "matrix")
    _, _, ahead = ticket_plan.fit_and_forecast(matrix, {"LinearRegression": models.linear}, 14)
    return ahead


_SUP = fx.DAILY + """,
numbered AS (SELECT series_id, date, CAST(num_violations AS DOUBLE) AS y, row_number() OVER o AS i, count(*) OVER (PARTITION BY series_id) AS n,
  CAST(lag(num_violations, 7) OVER o AS DOUBLE) AS x, lead(num_violations, 1) OVER o AS t1, lead(num_violations, 3) OVER o AS t3,
  lead(num_violations, 7) OVER o AS t7 FROM daily WINDOW o AS (PARTITION BY series_id ORDER BY date)),
sup AS (SELECT series_id, date, x, CAST(h AS INTEGER) AS horizon, CAST(CASE h WHEN 1 THEN t1 WHEN 3 THEN t3 ELSE t7 END AS DOUBLE) AS t
  FROM numbered, (SELECT unnest([1, 3, 7]) AS h) WHERE i > 30 AND i <= n - 7)"""


@query(
    "l1_one_feature_fit",
    f"""WITH {_SUP}, c AS (SELECT horizon, regr_slope(t, x) AS b, regr_intercept(t, x) AS a FROM sup WHERE date <= DATE '1999-12-31' GROUP BY 1),
e AS (SELECT horizon, t - (a + b * x) AS e FROM sup JOIN c USING (horizon) WHERE date > DATE '2000-12-31')
SELECT 'LinearRegression' AS model, horizon, {s6("avg(abs(e))", "mae")}, {s6("sqrt(avg(e * e))", "rmse")}, count(*) AS n FROM e GROUP BY horizon""",
)
def one_feature(spark, d):
    """The least-squares path of the training loop against SQL regression functions."""
    rows, _ = _supervised(spark, d)
    preds, _ = models.train_all(rows, {"LinearRegression": models.linear}, ["num_violations_lag_7"])
    x = evaluate.summarize(preds.where("split = 'test'"), ["model", "horizon"])
    return x.select("model", "horizon", r6("mae", "mae"), r6("rmse", "rmse"), "n")


@query(
    "l10_backtest_one_feature",
    f"""WITH {_SUP}, m AS (SELECT min(date) + 365 AS lo, max(date) - 90 AS hi FROM sup),
f AS (SELECT CAST(k AS INTEGER) AS fold, CAST(lo + CAST((hi - lo) * k // 3 AS INTEGER) AS DATE) AS cutoff FROM m, (SELECT unnest([1, 2, 3]) AS k)),
r AS (SELECT * FROM sup, f),
c AS (SELECT fold, horizon, regr_slope(t, x) AS b, regr_intercept(t, x) AS a FROM r WHERE date <= cutoff GROUP BY 1, 2),
e AS (SELECT fold, horizon, t - (a + b * x) AS e FROM r JOIN c USING (fold, horizon) WHERE date > cutoff)
SELECT fold, horizon, {s6("avg(abs(e))", "mae")}, {s6("sqrt(avg(e * e))", "rmse")} FROM e GROUP BY 1, 2""",
)
def backtest_one_feature(spark, d):
    rows, _ = _supervised(spark, d)
    x = models.backtest(rows, models.linear, ["num_violations_lag_7"])
    return x.select("fold", "horizon", r6("mae", "mae"), r6("rmse", "rmse"))


def _ar_sql() -> str:
    w = "OVER (PARTITION BY series_id ORDER BY date)"

    def det(cols):
        (p, q, r), (s, t, u), (v, x, y) = zip(*cols)
        return f"({p} * ({t} * {y} - {u} * {x}) - {q} * ({s} * {y} - {u} * {v}) + {r} * ({s} * {x} - {t} * {v}))"

    names = ["z1", "z7", "z8"]
    cov = {(i, j): f"covar_pop({i}, {j})" for i in names for j in names}
    cols = [[cov[i, j] for i in names] for j in names]
    right = [f"covar_pop({i}, z)" for i in names]
    solved = []
    for k, name in enumerate(("b1", "b7", "b8")):
        swapped = [right if i == k else c for i, c in enumerate(cols)]
        solved.append(f"{det(swapped)} / {det(cols)} AS {name}")
    sql = f"""WITH {fx.DAILY},
y0 AS (SELECT series_id, date, CAST(num_violations AS DOUBLE) AS y FROM daily),
d0 AS (SELECT *, (y - lag(y) {w}) - (lag(y, 7) {w} - lag(y, 8) {w}) AS z FROM y0),
p0 AS (SELECT *, lag(z, 1) {w} AS z1, lag(z, 7) {w} AS z7, lag(z, 8) {w} AS z8 FROM d0),
fit0 AS (SELECT * FROM p0 WHERE date <= DATE '1999-12-31' AND z IS NOT NULL AND z8 IS NOT NULL),
fit1 AS (SELECT {", ".join(solved)}, avg(z) AS mz, avg(z1) AS m1, avg(z7) AS m7, avg(z8) AS m8 FROM fit0),
fit AS (SELECT *, mz - b1 * m1 - b7 * m7 - b8 * m8 AS a FROM fit1),
s0 AS (SELECT d0.*, fit.*, {", ".join(f"lag(z, {k}) {w} AS zb{k}, lag(y, {k}) {w} AS yb{k}" for k in range(8))},
  lead(y, 1) {w} AS t1, lead(y, 3) {w} AS t3, lead(y, 7) {w} AS t7, z AS g0, y AS f0 FROM d0, fit)"""
    for k in range(1, 8):
        sql += f",\nu{k} AS (SELECT *, a + b1 * g{k - 1} + b7 * zb{7 - k} + b8 * zb{8 - k} AS g{k} FROM s{k - 1})"
        sql += f",\ns{k} AS (SELECT *, g{k} + f{k - 1} + yb{7 - k} - yb{8 - k} AS f{k} FROM u{k})"
    parts = [
        f"SELECT CAST({h} AS INTEGER) AS horizon, {s6(f'avg(abs(t{h} - f{h}))', 'mae')}, count(*) AS n FROM s7 WHERE t{h} IS NOT NULL AND f{h} IS NOT NULL"
        for h in (1, 3, 7)
    ]
    return sql + "\n" + " UNION ALL ".join(parts)


@query("l7_seasonal_autoregression", _ar_sql())
def seasonal(spark, d):
    x = models.seasonal_ar(fx.daily(spark, d), "num_violations", F.col("date") <= F.lit(fx.TRAIN_END).cast("date"))
    error = F.avg(F.abs(F.col("y_true") - F.col("y_pred")))
    return x.where("y_true IS NOT NULL").groupBy("horizon").agg(r6(error, "mae"), F.count(F.lit(1)).alias("n"))


def _geo_events(spark, d):
    e = fx.cell_events(spark, d)
    raw = e.select(F.col("ts").cast("string").alias("Issue_DateTime"), "latitude", "longitude")
    return cell_plan.cell_events(raw)


@query("l8_cell_hour_probability")
def geo(spark, d):
    return cell_plan.report(cell_plan.fit(_geo_events(spark, d)))


@query("l9_point_lookup")
def points(spark, d):
    """Each event as a point to look up; every 50th has no valid hour."""
    e = fx.cell_events(spark, d)
    fitted = cell_plan.fit(_geo_events(spark, d))
    p = e.select(
        "event_id",
        (F.col("latitude") + 0.0004).alias("latitude"),
        "longitude",
        F.when(F.col("event_id") % 50 == 0, 99).otherwise(F.col("hour")).alias("hour"),
        "day_of_week",
    )
    x = models.predict_points(p, fitted["model"], fitted["cells"], fitted["ranges"], fitted["month_mode"])
    return x.select("event_id", "hour", "day_of_week", "month", "grid_id", "score", "reject")


def _weights_sql(fit: str) -> str:
    """Weights of levels in SQL; ``fit`` says which events are learned from."""
    levels = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS BIGINT) AS level, count(*) AS trials, sum(label) AS hits FROM coded GROUP BY 2"
        for c in models.GEO_CODES
    )
    return fx.CELLS + f""",
fit_events AS (SELECT * FROM cell_events WHERE {fit}),
hits AS (SELECT date, lat_id, lon_id, hour, count(*) AS n FROM fit_events GROUP BY 1, 2, 3, 4),
hours AS (SELECT v.date, v.lat_id, v.lon_id, r.h AS hour FROM (SELECT DISTINCT date, lat_id, lon_id FROM hits) v, range(24) r(h)),
cells AS (SELECT lat_id, lon_id, row_number() OVER (ORDER BY lat_id, lon_id) - 1 AS grid_id FROM (SELECT DISTINCT lat_id, lon_id FROM fit_events)),
coded AS (SELECT o.hour, isodow(o.date) - 1 AS day_of_week, month(o.date) AS month, month(o.date) - 1 AS month_code, grid_id, CAST(n IS NOT NULL AS INTEGER) AS label
  FROM hours o JOIN cells c ON o.lat_id = c.lat_id AND o.lon_id = c.lon_id
  LEFT JOIN hits h ON o.date = h.date AND o.lat_id = h.lat_id AND o.lon_id = h.lon_id AND o.hour = h.hour),
whole AS (SELECT t, h, (h + 0.5::DOUBLE) / (t + 1.0::DOUBLE) AS p FROM (SELECT count(*) AS t, sum(label) AS h FROM coded)),
weights AS (
  SELECT 'intercept' AS feature, NULL::BIGINT AS level, ln(p / (1 - p)) AS weight, t AS trials, h AS hits FROM whole
  UNION ALL SELECT feature, level, ln((hits + p) / (trials - hits + 1 - p)) - ln(p / (1 - p)), trials, hits FROM ({levels}), whole)"""


@query(
    "l8_level_weights",
    f"WITH {_weights_sql('true')} SELECT feature, level, {s6('weight', 'weight')}, trials, CAST(hits AS BIGINT) AS hits FROM weights",
)
def level_weights(spark, d):
    """Log odds of every hour, weekday, month and cell, from all hours of the cells visited each day."""
    found = cell_plan.fit_weights(fx.cell_events(spark, d))["weights"]
    return found.select("feature", "level", r6("weight", "weight"), "trials", "hits")


_LEARNED = "event_type = 'purchase' AND date <= DATE '2024-01-03'"


@query(
    "l9_point_lookup_by_weights",
    f"""WITH {_weights_sql(_LEARNED)},
usual AS (SELECT month FROM coded GROUP BY 1 ORDER BY count(*) DESC, month LIMIT 1),
points AS (SELECT event_id, lat_id, lon_id, event_id % 50 = 1 AS nowhere,
    CASE WHEN event_id % 50 = 0 THEN 99 ELSE hour END AS hour, day_of_week,
    CAST(CASE WHEN event_id % 50 = 2 THEN 13 WHEN event_id % 2 = 0 THEN cell_events.month ELSE usual.month END AS INTEGER) AS month
  FROM cell_events, usual),
judged AS (SELECT *, CASE WHEN nowhere THEN 'no coordinates' WHEN hour > 23 THEN 'hour must be in 0..23'
    WHEN month > 12 THEN 'month must be in 1..12' END AS reject FROM points),
places AS (SELECT DISTINCT lat_id, lon_id FROM judged WHERE reject IS NULL),
near AS (SELECT p.lat_id, p.lon_id, arg_min(c.grid_id, power(p.lat_id - c.lat_id, 2) + power(p.lon_id - c.lon_id, 2) + c.grid_id * 1e-9) AS grid_id
  FROM places p, cells c GROUP BY 1, 2),
w AS (SELECT feature, level, weight FROM weights WHERE level IS NOT NULL)
SELECT event_id, CAST(j.hour AS INTEGER) AS hour, day_of_week, j.month, n.grid_id, reject,
  round(CASE WHEN reject IS NULL THEN 1 / (1 + exp(-((SELECT weight FROM weights WHERE level IS NULL) + coalesce(a.weight, 0) + coalesce(b.weight, 0)
    + coalesce(c.weight, 0) + coalesce(g.weight, 0)))) END, 6) + 0.0 AS score
FROM judged j
LEFT JOIN near n ON reject IS NULL AND j.lat_id = n.lat_id AND j.lon_id = n.lon_id
LEFT JOIN w a ON a.feature = 'hour' AND a.level = j.hour
LEFT JOIN w b ON b.feature = 'day_of_week' AND b.level = day_of_week
LEFT JOIN w c ON c.feature = 'month_code' AND c.level = j.month - 1
LEFT JOIN w g ON g.feature = 'grid_id' AND g.level = n.grid_id""",
)
def points_by_weights(spark, d):
    """Each event as a point to look up, by weights learned from the first days' purchases; cells not seen there take the nearest.

    Some points have no valid hour, no latitude or no valid month; of the others, every second has no month.
    """
    e = fx.cell_events(spark, d)
    fitted = cell_plan.fit_weights(e.where(_LEARNED))
    rest = F.col("event_id") % 50
    p = e.select(
        "event_id",
        F.when(rest != 1, F.col("latitude") + 0.0004).alias("latitude"),
        "longitude",
        F.when(rest == 0, 99).otherwise(F.col("hour")).alias("hour"),
        "day_of_week",
        F.when(rest == 2, 13).when(F.col("event_id") % 2 == 0, F.col("month")).alias("month"),
    )
    x = models.predict_points(p, fitted["weights"], fitted["cells"], fitted["ranges"], fitted["month_mode"])
    return x.select("event_id", "hour", "day_of_week", "month", "grid_id", r6("score", "score"), "reject")


@query("l10_rolling_origin_backtest")
def backtest(spark, d):
    rows, features = _supervised(spark, d)
    return models.backtest(rows, models.linear, features)


@query("l11_learning_curve")
def curve(spark, d):
    rows, features = _supervised(spark, d)
    return models.learning_curve(rows, models.forest(10), features, "y_t_plus_1")


@query("m19_permutation_importance")
def permutation(spark, d):
    rows, features = _supervised(spark, d)
    ready = models.ready(rows, features, "y_t_plus_1")
    model = models.linear(ready.where("split = 'train'"), features)
    return models.permutation_importance(model, ready.where("split = 'test'"), features, KEYS)


@query(
    "m19_importance_of_fixed_weights",
    f"""WITH {fx.PREDS},
rows_ AS (SELECT y_true AS label, [CAST(y_pred AS DOUBLE), CAST(horizon AS DOUBLE), CAST(day(date) AS DOUBLE)] AS x,
  row_number() OVER (ORDER BY {fx.key_hash_sql("split", "model", "horizon", "series_id", "date", seed=42)}, split, model, horizon, series_id, date) - 1 AS i
  FROM preds WHERE y_true IS NOT NULL AND y_pred IS NOT NULL),
starts AS (SELECT r, n, 1 + (r * 2654435761 + 42 * 40503) % n AS s, (r * 40692 + 42) * 48271 % n AS shift
  FROM (SELECT count(*) AS n FROM rows_), (SELECT CAST(unnest(generate_series(1, 10)) AS BIGINT) AS r)),
ways AS (SELECT r, n, shift, min(c) AS step FROM (SELECT r, n, shift, unnest(generate_series(s, s + 64)) AS c FROM starts) WHERE gcd(c, n) = 1 GROUP BY ALL),
pairs AS (SELECT r, a.label, a.x, b.x AS donor FROM rows_ b CROSS JOIN ways w JOIN rows_ a ON a.i = (w.step * b.i + w.shift) % w.n),
scored AS (SELECT r, j, label - (0.9 * CASE WHEN j = 1 THEN donor[1] ELSE x[1] END + 0.1 * CASE WHEN j = 2 THEN donor[2] ELSE x[2] END
  + 0.02 * CASE WHEN j = 3 THEN donor[3] ELSE x[3] END) AS e FROM pairs, (SELECT unnest([1, 2, 3]) AS j)),
whole AS (SELECT sum(power(label - (0.9 * x[1] + 0.1 * x[2] + 0.02 * x[3]), 2)) AS sse, var_pop(label) * count(*) AS sst FROM rows_),
per AS (SELECT j, r, (sum(e * e) - any_value(whole.sse)) / any_value(whole.sst) AS loss FROM scored, whole GROUP BY j, r)
SELECT ['y_pred', 'horizon', 'day'][j] AS feature, {s6("avg(loss)", "importance")}, {s6("stddev_pop(loss)", "spread")} FROM per GROUP BY j""",
)
def permutation_fixed(spark, d):
    """Importance of three inputs of a line with given weights, over all predictions."""
    keys = ["split", "model", "horizon", "series_id", "date"]
    preds = fx.predictions(spark, d).where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    rows = preds.select(*keys, F.col("y_true").cast("double").alias(models.LABEL), "y_pred", F.dayofmonth("date").alias("day"))
    x = models.permutation_importance(lambda v: v[0] * 0.9 + v[1] * 0.1 + v[2] * 0.02, rows, ["y_pred", "horizon", "day"], keys)
    return x.select("feature", r6("importance", "importance"), r6("spread", "spread"))


@query(
    "c8_daily_matrix",
    f"""WITH {fx.TICKETS}, m AS (SELECT date, count(*) AS tickets, count(*) FILTER (WHERE violation = 'F') AS viol_F,
  count(*) FILTER (WHERE violation NOT IN ('F', 'O', 'P')) AS "viol_OTHER" FROM tickets GROUP BY date)
SELECT date, tickets, viol_F AS "viol_F", "viol_OTHER", CAST(date - min(date) OVER () AS INTEGER) AS days_since_start,
  coalesce(lag(tickets, 1) OVER (ORDER BY date), 0) AS lag_1, coalesce(lag(tickets, 3) OVER (ORDER BY date), 0) AS lag_3,
  coalesce(lag(tickets, 7) OVER (ORDER BY date), 0) AS lag_7,
  {s6("avg(tickets) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", "ma_7")} FROM m""",
)
def matrix(spark, d):
    t = fx.tickets(spark, d).withColumn("issue_date", F.col("issue_ts").cast("string"))
    x = ticket_plan.daily_matrix(t, "agency", "violation")
    return x.select("date", "tickets", "viol_F", "viol_OTHER", "days_since_start", "lag_1", "lag_3", "lag_7", r6("ma_7", "ma_7"))


# the daily feature table's numeric columns
_FEATURES = (
    [f"num_violations_lag_{k}" for k in (1, 7, 14, 30)]
    + ["num_violations_roll7_mean", "num_violations_roll30_mean", "num_violations_roll30_std", "year", "month", "is_holiday", "is_weekend"]
    + ["roc_vs_roll7", "is_cherry_blossom", "is_eom", "sin_1", "cos_1", "sin_2", "cos_2"]
    + [f"dow_{x}" for x in calendar.WEEKDAYS if x != sorted(calendar.WEEKDAYS)[0]]
)
_LISTED = "(SELECT unnest([" + ", ".join(f"'{f}'" for f in _FEATURES) + "]) AS feature)"
_TWO = ["num_violations_lag_7", "num_violations_lag_1"]

# two features, so that least squares has a closed form
_SUP2 = fx.DAILY + """,
numbered AS (SELECT series_id, date, row_number() OVER o AS i, count(*) OVER (PARTITION BY series_id) AS n,
  CAST(lag(num_violations, 7) OVER o AS DOUBLE) AS x1, CAST(lag(num_violations, 1) OVER o AS DOUBLE) AS x2, lead(num_violations, 1) OVER o AS t1,
  lead(num_violations, 3) OVER o AS t3, lead(num_violations, 7) OVER o AS t7 FROM daily WINDOW o AS (PARTITION BY series_id ORDER BY date)),
sup AS (SELECT series_id, date, x1, x2, CAST(h AS INTEGER) AS horizon, CAST(CASE h WHEN 1 THEN t1 WHEN 3 THEN t3 ELSE t7 END AS DOUBLE) AS t
  FROM numbered, (SELECT unnest([1, 3, 7]) AS h) WHERE i > 30 AND i <= n - 7)"""


def _two_sql(rows: str, by: str, where: str) -> str:
    return f"""k AS (SELECT {by}, avg(t) AS mt, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v1, var_pop(x2) AS v2, covar_pop(x1, x2) AS c12,
  covar_pop(x1, t) AS c1, covar_pop(x2, t) AS c2 FROM {rows} WHERE {where} GROUP BY {by}),
b AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM k),
c AS (SELECT {by}, b1, b2, mt - b1 * m1 - b2 * m2 AS a FROM b)"""


@query(
    "l5_batched_two_feature_fits",
    f"""WITH {_SUP2}, {_two_sql("sup", "series_id, horizon", "date <= DATE '1999-12-31'")},
e AS (SELECT series_id, horizon, t - (a + b1 * x1 + b2 * x2) AS e FROM sup JOIN c USING (series_id, horizon) WHERE date > DATE '2000-12-31')
SELECT series_id, horizon, {s6("avg(abs(e))", "mae")}, {s6("sqrt(avg(e * e))", "rmse")}, count(*) AS n FROM e GROUP BY 1, 2""",
)
def batched_two(spark, d):
    """A fit for every series and horizon, all solved together from one aggregate, on the test rows."""
    rows, _ = _supervised(spark, d)
    preds, _ = moments.train_linear(rows, _TWO, by=["series_id"])
    x = evaluate.summarize(preds.where("split = 'test'"), ["series_id", "horizon"])
    return x.select("series_id", "horizon", r6("mae", "mae"), r6("rmse", "rmse"), "n")


@query(
    "l5_batched_residuals_orthogonal",
    f"""WITH {_SUP2} SELECT series_id, horizon, feature, count(*) AS n, TRUE AS orthogonal, TRUE AS unbiased
FROM sup, {_LISTED} WHERE date <= DATE '1999-12-31' GROUP BY 1, 2, 3""",
)
def batched_orthogonal(spark, d):
    """Fits of all features for every series and horizon: what is left of the target has nothing in common with any feature."""
    rows, features = _supervised(spark, d)
    train, targets = rows.where("split = 'train'"), [f"y_t_plus_{h}" for h in (1, 3, 7)]
    fits = moments.fit_linear(train, features, targets, ["series_id"])
    left = moments.predict_all(train, fits, features, targets, ["series_id"], features).withColumn("e", F.col("y_true") - F.col("y_pred"))
    tol = 1e-6 * F.stddev_pop("y_true")
    checks = F.array(*[F.struct(F.lit(f).alias("feature"), (F.abs(F.covar_pop(F.col(f).cast("double"), "e")) <= tol * F.stddev_pop(f)).alias("orthogonal")) for f in features])
    horizon = F.get(F.array(F.lit(1), F.lit(3), F.lit(7)), F.col("target")).alias("horizon")
    per = left.groupBy("series_id", horizon).agg(F.count(F.lit(1)).alias("n"), (F.abs(F.avg("e")) <= tol).alias("unbiased"), checks.alias("checks"))
    return per.select("series_id", "horizon", "n", "unbiased", F.inline("checks"))


@query(
    "l10_backtest_two_features",
    f"""WITH {_SUP2}, m AS (SELECT min(date) + 365 AS lo, max(date) - 90 AS hi FROM sup),
f AS (SELECT CAST(k AS INTEGER) AS fold, CAST(lo + CAST((hi - lo) * k // 3 AS INTEGER) AS DATE) AS cutoff FROM m, (SELECT unnest([1, 2, 3]) AS k)),
r AS (SELECT * FROM sup, f), {_two_sql("r", "fold, horizon", "date <= cutoff")},
e AS (SELECT fold, horizon, t - (a + b1 * x1 + b2 * x2) AS e FROM r JOIN c USING (fold, horizon) WHERE date > cutoff)
SELECT fold, horizon, {s6("avg(abs(e))", "mae")}, {s6("sqrt(avg(e * e))", "rmse")} FROM e GROUP BY 1, 2""",
)
def backtest_two(spark, d):
    """All folds and horizons from the moments of the stretches between cutoffs."""
    rows, _ = _supervised(spark, d)
    return moments.backtest_linear(rows, _TWO).select("fold", "horizon", r6("mae", "mae"), r6("rmse", "rmse"))


@query(
    "l2_lasso_one_feature",
    f"""WITH {_SUP}, rows_of AS (SELECT date, x, t FROM sup WHERE horizon = 1 AND date <= DATE '1999-12-31'),
days AS (SELECT date, (row_number() OVER (ORDER BY date) - 1) * 5 // count(*) OVER () AS fold FROM (SELECT DISTINCT date FROM rows_of)),
r AS (SELECT fold, x, t FROM rows_of JOIN days USING (date)),
al AS (SELECT stddev_pop(x) AS s, covar_pop(x, t) / stddev_pop(x) AS r, avg(x) AS mx, avg(t) AS mt FROM r),
grid AS (SELECT i, abs(r) * power(CAST(0.001 AS DOUBLE), i / CAST(99 AS DOUBLE)) AS penalty FROM al, range(100) g(i)),
o AS (SELECT h.fold, avg(x) AS mx, avg(t) AS mt, var_pop(x) AS v, covar_pop(x, t) AS c FROM r, (SELECT DISTINCT fold FROM r) h WHERE r.fold <> h.fold GROUP BY h.fold),
w AS (SELECT o.fold, i, penalty, o.mx, o.mt, sign(c) * greatest(abs(c / s) - penalty, 0) / (v / (s * s)) / s AS w FROM o, al, grid),
errors AS (SELECT fold, i, penalty, avg(power(t - mt - w * (x - mx), 2)) AS mse FROM w JOIN r USING (fold) GROUP BY 1, 2, 3),
best AS (SELECT penalty, avg(mse) AS mse FROM errors GROUP BY i, penalty ORDER BY 2, 1 DESC LIMIT 1)
SELECT {s6("penalty", "penalty")}, {s6("mse", "mse")}, {s6("sign(r) * greatest(abs(r) - penalty, 0) / s", "weight")},
  {s6("mt - sign(r) * greatest(abs(r) - penalty, 0) / s * mx", "intercept")} FROM best, al""",
)
def lasso_one(spark, d):
    """Penalty, cross-validated error, weight and intercept of a lasso of one feature, which has a closed form."""
    rows, _ = _supervised(spark, d)
    train = models.contiguous_folds(rows.where("split = 'train'"), 5)
    model, errors = moments.lasso_from_moments(train, _TWO[:1], "y_t_plus_1", "fold")
    found = [F.lit(model.penalty), F.lit(min(e for _, e in errors)), F.lit(model.weights[0]), F.lit(model.intercept)]
    return spark.range(1).select(*[r6(c, n) for c, n in zip(found, ("penalty", "mse", "weight", "intercept"))])


@query("l2_lasso_optimal", f"SELECT feature, TRUE AS optimal FROM {_LISTED}")
def lasso_optimal(spark, d):
    """The chosen lasso of all features fulfils its optimality conditions, as the rows themselves show."""
    rows, features = _supervised(spark, d)
    return moments.optimality(rows.where("split = 'train'"), _lasso(rows, features), "y_t_plus_1").select("feature", "optimal")


_ROLLED = moments.LinearModel(
    ("num_violations_lag_1", "num_violations_lag_7", "num_violations_roll7_mean", "num_violations_roll30_std", "is_weekend"), 0.5, (0.25, 0.35, 0.2, 0.1, 1.0)
)
_RECENT = """recent AS (SELECT series_id, max(date) AS last, list(CAST(num_violations AS DOUBLE) ORDER BY date) AS l
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS back FROM daily) WHERE back <= 30 GROUP BY series_id HAVING count(*) = 30)"""


@query(
    "l6_roll_forward_fixed_model",
    f"""WITH RECURSIVE {fx.DAILY}, {_RECENT},
ahead(series_id, date, step, l, y) AS (
  SELECT series_id, last, 0, l, CAST(0 AS DOUBLE) FROM recent
  UNION ALL
  SELECT series_id, date, step, list_append(l[2:], y), y FROM (
    SELECT series_id, CAST(date + 1 AS DATE) AS date, step + 1 AS step, l, greatest(CAST(0 AS DOUBLE), CAST(0.5 AS DOUBLE) + CAST(0.25 AS DOUBLE) * l[30] + CAST(0.35 AS DOUBLE) * l[24]
      + CAST(0.2 AS DOUBLE) * list_avg(l[24:30]) + CAST(0.1 AS DOUBLE) * list_aggregate(l, 'stddev_samp') + CASE WHEN isodow(date + 1) >= 6 THEN 1 ELSE 0 END) AS y
    FROM ahead WHERE step < 28))
SELECT series_id, date, step, {s6("y", "y_pred")} FROM ahead WHERE step > 0""",
)
def rolled(spark, d):
    """28 days by a given model; later days see the days forecast before them."""
    known = lambda on: {"is_weekend": calendar.is_weekend(on).cast("int")}
    x = forward.roll_forward(fx.daily(spark, d), _ROLLED, "num_violations", 28, (1, 7), ((7, "mean"), (30, "std")), known)
    return x.select("series_id", "date", "step", r6("y_pred", "y_pred"))


@query(
    "l6_fit_and_roll_forward",
    f"""WITH RECURSIVE {fx.DAILY}, {_RECENT},
sup AS (SELECT 1 AS one, date, CAST(num_violations AS DOUBLE) AS t, CAST(lag(num_violations, 1) OVER o AS DOUBLE) AS x1, CAST(lag(num_violations, 7) OVER o AS DOUBLE) AS x2
  FROM daily WINDOW o AS (PARTITION BY series_id ORDER BY date)),
{_two_sql("sup", "one", "date <= DATE '1999-12-31' AND x2 IS NOT NULL")},
ahead(series_id, date, step, l, y) AS (
  SELECT series_id, last, 0, l, CAST(0 AS DOUBLE) FROM recent
  UNION ALL
  SELECT series_id, date, step, list_append(l[2:], y), y FROM (
    SELECT series_id, CAST(date + 1 AS DATE) AS date, step + 1 AS step, l, greatest(CAST(0 AS DOUBLE), a + b1 * l[30] + b2 * l[24]) AS y FROM ahead, c WHERE step < 14))
SELECT series_id, date, step, {s6("y", "y_pred")} FROM ahead WHERE step > 0""",
)
def fit_and_roll(spark, d):
    """A least-squares model of yesterday and a week ago, fitted on the training years and rolled two weeks forward."""
    t = fx.tickets(spark, d).withColumnRenamed("agency", "series_id")
    ahead, _ = daily_plan.forecast_days(aggregate.daily_counts(t, "date", ["series_id"]), 14, (1, 7), (), until=fx.TRAIN_END)
    return ahead.select("series_id", "date", "step", r6("y_pred", "y_pred"))


_FRAME = moments.LinearModel(("day_of_week", "is_weekend", "month", "days_since_start", "lag_7", "ma_7"), 12.0, (0.5, -2.0, 0.25, 0.01, 0.6, 0.3))


@query(
    "l6_zero_filled_frame",
    f"""WITH {fx.TICKETS}, ends AS (SELECT min(date) AS lo, max(date) AS hi FROM tickets),
f AS (SELECT CAST(hi + CAST(k AS INTEGER) AS DATE) AS date, lo FROM ends, (SELECT unnest(range(1, 15)) AS k))
SELECT 'city' AS series_id, date, {s6("12 + CAST(0.5 AS DOUBLE) * (isodow(date) - 1) - CASE WHEN isodow(date) >= 6 THEN 2 ELSE 0 END + CAST(0.25 AS DOUBLE) * month(date) + CAST(0.01 AS DOUBLE) * (date - lo)", "y_pred")}
FROM f""",
)
def zero_filled(spark, d):
    """The frame of future days, whose recency is unknown and counts as 0, through a given model."""
    t = fx.tickets(spark, d).withColumn("issue_date", F.col("issue_ts").cast("string"))
    matrix = materialize(ticket_plan.daily_matrix(t, "agency", "violation"), "matrix")
    frame = ticket_plan.future_frame(matrix, ticket_plan.matrix_features(matrix), 14)
    return forward.score_frame(frame, _FRAME).select("series_id", "date", r6("y_pred", "y_pred"))
