"""Counts, pivots, moments, histograms and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar, encode
from ..operators import aggregate, evaluate, ordering, profile, reshape, spatial
from . import fixtures as fx
from .q_densify import _VISITED
from .registry import query, r6, s6


@query("d1_daily_count", f"WITH {fx.SHIPMENTS} SELECT agency, date, count(*) AS num_violations FROM shipments GROUP BY 1, 2")
def daily_count(spark, d):
    return aggregate.daily_counts(fx.shipments(spark, d), "date", ["agency"])


@query(
    "d2_weekly_count",
    f"""WITH {fx.TICKETS}, {fx.HOLIDAYS}, w AS (
  SELECT CAST(date_trunc('week', date) AS DATE) AS week, count(*) AS num_violations FROM tickets GROUP BY 1),
hw AS (SELECT DISTINCT CAST(date_trunc('week', d) AS DATE) AS week FROM holidays)
SELECT week, num_violations, CAST(year(week) AS INTEGER) AS year, CAST(month(week) AS INTEGER) AS month,
  CAST(weekofyear(week) AS INTEGER) AS week_of_year, week IN (SELECT week FROM hw) AS is_holiday_week FROM w""",
)
def weekly_count(spark, d):
    return aggregate.weekly_counts(fx.tickets(spark, d), "date")


@query(
    "d3_monthly_count",
    f"WITH {fx.SHIPMENTS} SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n FROM shipments GROUP BY 1",
)
def monthly(spark, d):
    return aggregate.counts_by(fx.shipments(spark, d), {"month": calendar.month_start(F.col("date"))})


@query("d3_weekday_count", f"WITH {fx.SHIPMENTS} SELECT dayname(date) AS day_name, count(*) AS n FROM shipments GROUP BY 1")
def weekday_count(spark, d):
    return aggregate.counts_by(fx.shipments(spark, d), {"day_name": calendar.weekday_name(F.col("date"))})


@query("d3_hour_count", "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1")
def hour_count(spark, d):
    return aggregate.counts_by(fx.table(spark, d, "events"), {"hour": F.hour("ts")})


_AG = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "d4_pivot_count",
    f"""WITH {fx.TICKETS} SELECT date, count(*) AS num_violations,
  {", ".join(f"count(*) FILTER (WHERE agency = '{a}') AS {chr(34)}agency_{a}{chr(34)}" for a in _AG)} FROM tickets GROUP BY date""",
)
def pivot(spark, d):
    return aggregate.pivot_counts(fx.tickets(spark, d), ["date"], "agency", _AG, "agency_", "num_violations")


_TOP5 = f"""{fx.TICKETS}, t AS (SELECT *, CAST(location_id % 40 AS VARCHAR) AS code FROM tickets),
top AS (SELECT code FROM t GROUP BY code ORDER BY count(*) DESC, code LIMIT 5)"""


@query(
    "d5_top_k_other",
    f"""WITH {_TOP5} SELECT CASE WHEN code IN (SELECT code FROM top) THEN code ELSE 'OTHER' END AS code_group, count(*) AS n
FROM t GROUP BY 1""",
)
def top_k_other(spark, d):
    t = fx.tickets(spark, d).select((F.col("location_id") % 40).alias("code"))
    x = aggregate.top_k_other(t, "code", 5, "code_group")
    return x.groupBy("code_group").agg(F.count(F.lit(1)).alias("n"))


@query("d6_cell_count", f"WITH {fx.CELLS} SELECT hour_bin, lat_id, lon_id, count(*) AS ticket_count FROM cell_events GROUP BY 1, 2, 3")
def cell_count(spark, d):
    return aggregate.cell_counts(fx.cell_events(spark, d), ["hour_bin", "lat_id", "lon_id"])


@query(
    "d7_representative_points",
    f"""WITH {_VISITED}, m AS (SELECT date, lat_id, lon_id, hour, median(latitude) AS lat, median(longitude) AS lon FROM cell_events GROUP BY 1, 2, 3, 4)
SELECT s.date, s.lat_id, s.lon_id, s.hour, s.label, {s6("coalesce(lat, s.lat_id / 1000.0)", "latitude")},
  {s6("coalesce(lon, s.lon_id / 1000.0)", "longitude")}, CAST(isodow(s.date) - 1 AS INTEGER) AS day_of_week, CAST(month(s.date) AS INTEGER) AS month
FROM samples s LEFT JOIN m ON s.date = m.date AND s.lat_id = m.lat_id AND s.lon_id = m.lon_id AND s.hour = m.hour""",
)
def representative(spark, d):
    from ..operators.densify import visited_grid

    e = fx.cell_events(spark, d)
    x = spatial.representative_points(e, visited_grid(e))
    return x.select(
        "date", "lat_id", "lon_id", "hour", "label", r6("latitude", "latitude"), r6("longitude", "longitude"), "day_of_week", "month"
    )


@query(
    "d8_spatial_weights",
    f"""WITH {fx.CELLS}, c AS (SELECT day_of_week, month, lat_id, lon_id, count(*) AS n FROM cell_events GROUP BY 1, 2, 3, 4)
SELECT day_of_week, month, lat_id, lon_id, {s6("n / sum(n) OVER (PARTITION BY day_of_week, month)", "weight")} FROM c""",
)
def weights(spark, d):
    w = spatial.spatial_weights(fx.cell_events(spark, d))
    return w.select("day_of_week", "month", "lat_id", "lon_id", r6("weight", "weight"))


@query(
    "d9_group_mean",
    f"""SELECT l_orderkey, l_linenumber, {s6("avg(l_quantity) OVER (PARTITION BY l_suppkey)", "mean_quantity")} FROM lineitem""",
)
def group_mean(spark, d):
    t = fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    x = aggregate.group_mean(t, "l_suppkey", "l_quantity", "mean_quantity")
    return x.select("l_orderkey", "l_linenumber", r6("mean_quantity", "mean_quantity"))


@query(
    "d10_distance_to_center",
    f"""WITH {fx.CELLS}, m AS (SELECT median(latitude) AS a, median(longitude) AS b FROM cell_events)
SELECT event_id, {s6("sqrt(power(latitude - a, 2) + power(longitude - b, 2))", "dist_center")} FROM cell_events, m""",
)
def distance(spark, d):
    return spatial.dist_center(fx.cell_events(spark, d)).select("event_id", r6("dist_center", "dist_center"))


@query(
    "d11_horizon_totals",
    f"""WITH {fx.PREDS} SELECT horizon, model, {s6("sum(y_true)", "total_actual")}, {s6("sum(y_pred)", "total_predicted")}
FROM preds WHERE split = 'test' GROUP BY 1, 2""",
)
def horizon_totals(spark, d):
    x = evaluate.totals(fx.predictions(spark, d).where("split = 'test'"), ["horizon", "model"])
    return x.select("horizon", "model", r6("total_actual", "total_actual"), r6("total_predicted", "total_predicted"))


@query("d12_mode", f"WITH {fx.SHIPMENTS} SELECT CAST(month(date) AS INTEGER) AS month_mode FROM shipments GROUP BY month(date) ORDER BY count(*) DESC, 1 LIMIT 1")
def mode(spark, d):
    return aggregate.mode_value(fx.shipments(spark, d).select(F.month("date").alias("month")), "month")


@query(
    "d13_feature_ranges",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_linenumber")
    ),
)
def ranges(spark, d):
    return aggregate.feature_ranges(fx.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"])


def _moments(ddof, fn):
    return f"WITH {fx.DAILY} SELECT 'num_violations' AS \"column\", {s6('avg(num_violations)', 'mean')}, {s6(fn + '(num_violations)', 'std')} FROM daily"


@query("d14_moments_population", _moments(0, "stddev_pop"))
def moments_pop(spark, d):
    x = aggregate.fit_scaler(fx.daily(spark, d), ["num_violations"], 0)
    return x.select("column", r6("mean", "mean"), r6("std", "std"))


@query("d14_moments_sample", _moments(1, "stddev_samp"))
def moments_samp(spark, d):
    x = aggregate.fit_scaler(fx.daily(spark, d), ["num_violations"], 1)
    return x.select("column", r6("mean", "mean"), r6("std", "std"))


@query(
    "d15_residual_histogram",
    f"""WITH {fx.PREDS}, e AS (SELECT horizon, y_true - y_pred AS e FROM preds WHERE split = 'test' AND model = 'mean7'),
r AS (SELECT min(e) AS lo, max(e) AS hi, (max(e) - min(e)) / 17 AS w FROM e),
b AS (SELECT horizon, CAST(least(floor((e - lo) / w), 16) AS INTEGER) AS bin, count(*) AS n FROM e, r GROUP BY 1, 2)
SELECT h.horizon, CAST(k AS INTEGER) AS bin, {s6("lo + k * w", "left_edge")}, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT horizon FROM e) h CROSS JOIN range(17) t(k) CROSS JOIN r LEFT JOIN b ON b.horizon = h.horizon AND b.bin = k""",
)
def histogram(spark, d):
    p = fx.predictions(spark, d).where("split = 'test' AND model = 'mean7'")
    x = evaluate.histogram(evaluate.residuals(p), "error", 17, ["horizon"])
    return x.select("horizon", "bin", r6("left_edge", "left_edge"), "n")


@query(
    "d15_price_histogram",
    """WITH r AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS w FROM lineitem),
b AS (SELECT CAST(least(floor((l_extendedprice - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n FROM lineitem, r GROUP BY 1)
SELECT CAST(k AS INTEGER) AS bin, round(lo + k * w, 6) + 0.0 AS left_edge, CAST(coalesce(n, 0) AS BIGINT) AS n
FROM range(20) t(k) CROSS JOIN r LEFT JOIN b ON b.bin = k""",
)
def price_histogram(spark, d):
    x = evaluate.histogram(fx.table(spark, d, "lineitem").select("l_extendedprice"), "l_extendedprice", 20)
    return x.select("bin", r6("left_edge", "left_edge"), "n")


@query(
    "d17_weekday_error",
    f"""WITH {fx.PREDS} SELECT model, horizon, dayname(date) AS weekday, {s6("avg(abs(y_pred - y_true))", "mae")},
  CAST(dayofweek(date) + 1 AS INTEGER) AS weekday_order FROM preds WHERE split = 'test' GROUP BY model, horizon, dayname(date), dayofweek(date)""",
)
def weekday_error(spark, d):
    x = evaluate.segment_error(fx.predictions(spark, d).where("split = 'test'"), "weekday")
    return x.select("model", "horizon", "weekday", r6("mae", "mae"), "weekday_order")


@query(
    "d17_month_error",
    f"""WITH {fx.PREDS} SELECT model, horizon, strftime(date, '%Y-%m') AS month, {s6("avg(abs(y_pred - y_true))", "mae")}
FROM preds WHERE split = 'test' GROUP BY 1, 2, 3""",
)
def month_error(spark, d):
    x = evaluate.segment_error(fx.predictions(spark, d).where("split = 'test'"), "month")
    return x.select("model", "horizon", "month", r6("mae", "mae"))


@query(
    "d18_leaderboard_matrix",
    f"""WITH {fx.PREDS}, {fx.BOARD} SELECT model,
  {", ".join(s6(f"avg(mae) FILTER (WHERE horizon = {h})", f"t_plus_{h}") for h in (1, 3, 7))} FROM board GROUP BY model""",
)
def matrix(spark, d):
    b = evaluate.summarize(fx.predictions(spark, d).where("split = 'test'"), ["horizon", "model"])
    x = evaluate.leaderboard_matrix(b, [1, 3, 7])
    return x.select("model", *[r6(f"t_plus_{h}", f"t_plus_{h}") for h in (1, 3, 7)])


_MEASURES = f"""{s6("avg(abs(y_true - y_pred))", "mae")}, {s6("sqrt(avg(power(y_true - y_pred, 2)))", "rmse")},
  {s6("avg(CASE WHEN abs(y_true) > 1e-8 THEN abs(y_true - y_pred) / abs(y_true) END) * 100", "mape")},
  {s6("avg(200 * abs(y_true - y_pred) / (abs(y_true) + abs(y_pred) + 1e-8))", "smape")},
  {s6("sum(abs(y_true - y_pred)) / (sum(abs(y_true)) + 1e-8) * 100", "wape")}, count(*) AS n"""


@query(
    "d19_leaderboards",
    f"""WITH {fx.PREDS} SELECT CASE WHEN grouping(split) = 1 THEN 'overall' WHEN grouping(horizon) = 1 THEN 'split' ELSE 'horizon' END AS level,
  horizon, split, model, {_MEASURES} FROM preds GROUP BY GROUPING SETS ((model), (split, model), (horizon, split, model))""",
)
def leaderboards(spark, d):
    x = evaluate.leaderboards(fx.predictions(spark, d))
    return x.select("level", "horizon", "split", "model", *[r6(m, m) for m in ("mae", "rmse", "mape", "smape", "wape")], "n")


@query(
    "d20_row_sum",
    f"""WITH {fx.TICKETS} SELECT date, count(*) FILTER (WHERE violation IN ('F', 'O', 'P')) AS total FROM tickets GROUP BY date""",
)
def row_sum(spark, d):
    p = aggregate.pivot_counts(fx.tickets(spark, d), ["date"], "violation", ["F", "O", "P"], "viol_")
    return p.select("date", encode.row_sum([c for c in p.columns if c.startswith("viol_")]).alias("total"))


@query(
    "d21_date_union",
    f"WITH {fx.TICKETS}, {fx.SHIPMENTS} SELECT date FROM tickets UNION SELECT date FROM shipments",
)
def date_union(spark, d):
    return aggregate.date_union(fx.tickets(spark, d), fx.shipments(spark, d))


@query(
    "s1_multi_key_sort",
    f"WITH {fx.PREDS}, {fx.BOARD} SELECT horizon, model, {s6('mae', 'mae')}, {s6('rmse', 'rmse')} FROM board ORDER BY horizon, rmse, mae, model",
)
def multi_sort(spark, d):
    b = evaluate.summarize(fx.predictions(spark, d).where("split = 'test'"), ["horizon", "model"])
    return b.orderBy("horizon", "rmse", "mae", "model").select("horizon", "model", r6("mae", "mae"), r6("rmse", "rmse"))


@query(
    "s2_top_n",
    f"WITH {fx.TICKETS} SELECT location_id, count(*) AS n FROM tickets GROUP BY 1 ORDER BY n DESC, location_id LIMIT 20",
)
def top_n(spark, d):
    c = profile.value_counts(fx.tickets(spark, d), "location_id")
    return profile.top_n(c, "n", 20, ["location_id"])


@query(
    "s2_smallest_weeks",
    f"""WITH {fx.TICKETS} SELECT CAST(date_trunc('week', date) AS DATE) AS week, count(*) AS num_violations FROM tickets GROUP BY 1
ORDER BY num_violations, week LIMIT 5""",
)
def smallest(spark, d):
    w = aggregate.weekly_counts(fx.tickets(spark, d), "date").select("week", "num_violations")
    return profile.top_n(w, "num_violations", 5, ["week"], ascending=True)


@query(
    "s3_union_by_name",
    f"""WITH {fx.TICKETS}, {fx.SHIPMENTS} SELECT agency, violation, amount IS NULL AS no_amount, count(*) AS n
FROM (SELECT agency, violation, amount FROM tickets UNION ALL SELECT agency, violation, NULL FROM shipments) GROUP BY 1, 2, 3""",
)
def union(spark, d):
    x = reshape.union_by_name(fx.tickets(spark, d).select("amount", "agency", "violation"), fx.shipments(spark, d).select("violation", "agency"))
    return x.groupBy("agency", "violation", F.col("amount").isNull().alias("no_amount")).agg(F.count(F.lit(1)).alias("n"))


@query("s4_distinct", f"WITH {fx.CELLS} SELECT DISTINCT lat_id, lon_id FROM cell_events")
def distinct(spark, d):
    return fx.cell_events(spark, d).select("lat_id", "lon_id").distinct()


def _wide(p):
    cols = [
        F.max(F.when((F.col("model") == m) & (F.col("horizon") == h), F.col("y_pred"))).alias(f"{m} t+{h}")
        for m in ("last", "seasonal", "mean7")
        for h in (1, 3, 7)
    ]
    return p.groupBy("series_id", "date").agg(*cols)


@query("s5_tidy_predictions", f"WITH {fx.PREDS} SELECT series_id, date, model, horizon, {s6('y_pred', 'y_pred')} FROM preds")
def tidy(spark, d):
    x = reshape.tidy_predictions(_wide(fx.predictions(spark, d)), ["series_id", "date"])
    return x.select("series_id", "date", "model", "horizon", r6("y_pred", "y_pred"))


@query(
    "s6_wide_predictions",
    f"""WITH {fx.PREDS} SELECT series_id, date, max(y_true) AS actual,
  {", ".join(s6(f"max(y_pred) FILTER (WHERE model = '{m}')", m) for m in ("last", "seasonal", "mean7"))}
FROM preds WHERE horizon = 3 AND split = 'test' GROUP BY 1, 2""",
)
def wide(spark, d):
    p = fx.predictions(spark, d).where("horizon = 3 AND split = 'test'")
    x = reshape.wide_predictions(p, ["last", "seasonal", "mean7"], ["series_id", "date"])
    return x.select("series_id", "date", "actual", *[r6(m, m) for m in ("last", "seasonal", "mean7")])


@query(
    "m11_price_quantiles",
    f"""SELECT l_returnflag, {s6("quantile_cont(l_extendedprice, 0.05)", "q05")}, {s6("quantile_cont(l_extendedprice, 0.5)", "q50")},
  {s6("quantile_cont(l_extendedprice, 0.9)", "q90")} FROM lineitem GROUP BY l_returnflag""",
)
def quantiles(spark, d):
    x = ordering.exact_quantiles(
        fx.table(spark, d, "lineitem"), "l_extendedprice", {"q05": 0.05, "q50": 0.5, "q90": 0.9}, ["l_returnflag"]
    )
    return x.select("l_returnflag", *[r6(q, q) for q in ("q05", "q50", "q90")])
