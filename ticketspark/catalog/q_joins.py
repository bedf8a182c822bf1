"""Joins, alignment and holidays."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar
from ..operators import aggregate, evaluate, joins
from . import fixtures as fx
from .registry import query, r6, s6


@query(
    "e1_left_join_on_date",
    f"""WITH {fx.TICKETS}, {fx.SHIPMENTS}, a AS (SELECT date, count(*) AS num_violations FROM tickets GROUP BY 1),
b AS (SELECT date, count(*) FILTER (WHERE agency = 'A') AS agency_A, count(*) FILTER (WHERE agency = 'N') AS agency_N FROM shipments GROUP BY 1)
SELECT a.date, num_violations, CAST(coalesce(agency_A, 0) AS BIGINT) AS "agency_A", CAST(coalesce(agency_N, 0) AS BIGINT) AS "agency_N"
FROM a LEFT JOIN b ON a.date = b.date""",
)
def left_join(spark, d):
    a = aggregate.daily_counts(fx.tickets(spark, d), "date")
    b = aggregate.pivot_counts(fx.shipments(spark, d), ["date"], "agency", ["A", "N"], "agency_")
    return joins.left_join(a, b, ["date"], 0)


@query(
    "e2_left_join_on_cells",
    f"""WITH {fx.CELLS}, h AS (SELECT date, lat_id, lon_id, count(*) AS n FROM cell_events WHERE event_type = 'click' GROUP BY 1, 2, 3),
v AS (SELECT DISTINCT date, lat_id, lon_id FROM cell_events)
SELECT v.date, v.lat_id, v.lon_id, CAST(coalesce(n, 0) AS BIGINT) AS n FROM v LEFT JOIN h ON v.date = h.date AND v.lat_id = h.lat_id AND v.lon_id = h.lon_id""",
)
def cell_join(spark, d):
    e = fx.cell_events(spark, d)
    keys = ["date", "lat_id", "lon_id"]
    hits = aggregate.cell_counts(e.where("event_type = 'click'"), keys, "n")
    return joins.left_join(e.select(*keys).distinct(), hits, keys, 0)


_ALIGN = f"""WITH {fx.PREDS}, s AS (SELECT date, model || '_' || horizon AS name, sum(y_pred) AS v FROM preds WHERE split = 'test' GROUP BY 1, 2)
SELECT date, {", ".join(s6(f"max(v) FILTER (WHERE name = '{n}')", n) for n in ("last_1", "mean7_3", "seasonal_7"))}
FROM s WHERE name IN ('last_1', 'mean7_3', 'seasonal_7') GROUP BY date"""


@query("e3_align_series", _ALIGN)
def align(spark, d):
    p = fx.predictions(spark, d).where("split = 'test'")
    long = p.groupBy("date", F.concat_ws("_", "model", "horizon").alias("series")).agg(F.sum("y_pred").alias("value"))
    names = ["last_1", "mean7_3", "seasonal_7"]
    return joins.align_series(long, names).select("date", *[r6(n, n) for n in names])


@query(
    "e3_align_complete_cases",
    _ALIGN + " HAVING count(*) = 3",
)
def align_complete(spark, d):
    p = fx.predictions(spark, d).where("split = 'test'")
    long = p.groupBy("date", F.concat_ws("_", "model", "horizon").alias("series")).agg(F.sum("y_pred").alias("value"))
    names = ["last_1", "mean7_3", "seasonal_7"]
    return joins.align_series(long, names, complete=True).select("date", *[r6(n, n) for n in names])


@query(
    "e4_align_to_dates",
    f"""WITH {fx.TICKETS}, {fx.SHIPMENTS}, dates AS (SELECT DISTINCT date FROM shipments), a AS (SELECT date, count(*) AS num_violations FROM tickets GROUP BY 1)
SELECT dates.date, num_violations FROM dates LEFT JOIN a ON dates.date = a.date""",
)
def align_dates(spark, d):
    dates = aggregate.date_union(fx.shipments(spark, d))
    return joins.align_to_dates(dates, aggregate.daily_counts(fx.tickets(spark, d), "date"), ["date"])


@query(
    "e7_holiday_flag",
    f"""WITH {fx.SHIPMENTS}, {fx.HOLIDAYS} SELECT date, count(*) AS n, CAST(date IN (SELECT d FROM holidays) AS INTEGER) AS is_holiday
FROM shipments GROUP BY date""",
)
def holiday(spark, d):
    c = aggregate.daily_counts(fx.shipments(spark, d), "date", out="n")
    return c.withColumn("is_holiday", calendar.is_holiday(F.col("date")).cast("int"))


@query(
    "e8_holiday_week_flag",
    f"""WITH {fx.SHIPMENTS}, {fx.HOLIDAYS}, w AS (SELECT CAST(date_trunc('week', date) AS DATE) AS week, count(*) AS n FROM shipments GROUP BY 1)
SELECT week, n, EXISTS (SELECT 1 FROM holidays WHERE d BETWEEN week AND week + 6) AS is_holiday_week FROM w""",
)
def holiday_week(spark, d):
    w = aggregate.counts_by(fx.shipments(spark, d), {"week": calendar.week_start(F.col("date"))})
    return w.withColumn("is_holiday_week", calendar.is_holiday_week(F.col("week")))


@query(
    "e9_top_k_semi_join",
    f"""WITH {fx.TICKETS}, top AS (SELECT location_id FROM tickets GROUP BY 1 ORDER BY count(*) DESC, CAST(location_id AS VARCHAR) LIMIT 10)
SELECT ticket_id, location_id FROM tickets WHERE location_id IN (SELECT location_id FROM top)""",
)
def semi(spark, d):
    t = fx.tickets(spark, d).select("ticket_id", "location_id")
    top = aggregate.top_values(t, "location_id", 10).select(F.col("value").cast("long").alias("location_id"))
    return joins.semi_join(t, top, ["location_id"])


@query(
    "e10_anti_join_dates",
    f"""WITH {fx.TICKETS}, {fx.SHIPMENTS} SELECT DISTINCT date FROM shipments WHERE date NOT IN (SELECT date FROM tickets)""",
)
def anti(spark, d):
    days = aggregate.date_union(fx.shipments(spark, d))
    return joins.anti_join(days, fx.tickets(spark, d), ["date"])


@query(
    "e13_evaluation_summary",
    f"""WITH {fx.PREDS}, {fx.BOARD},
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY mae, model) AS rn FROM board) WHERE rn = 1),
best_base AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY mae, model) AS rn FROM board WHERE model IN ('last', 'seasonal')) WHERE rn = 1),
alpha AS (SELECT horizon, quantile_cont(abs(y_true - y_pred), 0.9) AS alpha FROM preds WHERE split = 'val' AND model = 'mean7' GROUP BY 1),
cov AS (SELECT p.horizon, avg(CASE WHEN y_true BETWEEN y_pred - alpha AND y_pred + alpha THEN 1.0 ELSE 0.0 END) AS empirical
  FROM preds p JOIN alpha a ON p.horizon = a.horizon WHERE split = 'test' AND model = 'mean7' GROUP BY 1),
folds AS (SELECT year(date) AS fold, horizon, avg(abs(y_true - y_pred)) AS mae FROM preds WHERE model = 'mean7' GROUP BY 1, 2),
cv AS (SELECT horizon, avg(mae) AS mae_mean, stddev_samp(mae) AS mae_std FROM folds GROUP BY 1)
SELECT best.horizon, best.model AS best_overall, {s6("best.mae", "best_mae")}, {s6("best.rmse", "best_rmse")}, {s6("best.mape", "best_mape")},
  best_base.model AS best_baseline, round_even((best_base.mae) * 100, 0) / 100 AS best_baseline_mae, round_even((best_base.mae - best.mae) * 100, 0) / 100 AS abs_improvement,
  round_even((best_base.mae - best.mae) / best_base.mae * 100 * 100, 0) / 100 AS pct_improvement, CAST(0.9 AS DOUBLE) AS nominal, {s6("empirical", "empirical")},
  {s6("mae_mean", "mae_mean")}, {s6("mae_std", "mae_std")}
FROM best JOIN best_base ON best.horizon = best_base.horizon JOIN cov ON best.horizon = cov.horizon JOIN cv ON best.horizon = cv.horizon""",
)
def summary(spark, d):
    p = fx.predictions(spark, d)
    board = evaluate.summarize(p.where("split = 'test'"), ["horizon", "model"])
    mean7 = p.where("model = 'mean7'")
    bands = evaluate.conformal(mean7.where("split = 'val'"), mean7.where("split = 'test'"))
    folds = evaluate.summarize(mean7.withColumn("fold", F.year("date")), ["fold", "horizon"])
    x = evaluate.evaluation_summary(
        evaluate.winners(board),
        evaluate.improvement(board, ["last", "seasonal"]),
        evaluate.coverage(bands),
        evaluate.cv_summary(folds),
    )
    exact = ["best_mae", "best_rmse", "best_mape", "empirical", "mae_mean", "mae_std"]
    return x.select(
        "horizon", "best_overall", "best_baseline", "best_baseline_mae", "abs_improvement", "pct_improvement", "nominal", *[r6(c, c) for c in exact]
    )
