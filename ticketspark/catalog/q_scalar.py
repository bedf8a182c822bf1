"""Calendar, encoding and report expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar, encode
from ..operators import aggregate, evaluate
from . import fixtures as fx
from .registry import query, r6, s6


@query(
    "x1_calendar_parts",
    f"""WITH {fx.TICKETS}
SELECT ticket_id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
       CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name,
       CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(dayofyear(date) AS INTEGER) AS day_of_year
FROM tickets""",
)
def calendar_parts(spark, d):
    t = calendar.with_calendar(fx.tickets(spark, d).select("ticket_id", "date"))
    return t.select("ticket_id", "year", "month", "day", "day_of_week", "day_name", "week_of_year", "day_of_year")


@query(
    "x2_weekend_flag",
    f"""WITH {fx.TICKETS} SELECT ticket_id, isodow(date) >= 6 AS is_weekend FROM tickets""",
)
def weekend(spark, d):
    return fx.tickets(spark, d).select("ticket_id", calendar.is_weekend(F.col("date")).alias("is_weekend"))


@query(
    "x3_fourier_terms",
    f"""WITH {fx.TICKETS} SELECT ticket_id,
{", ".join(s6(f"{f}(2 * pi() * {k} * dayofyear(date) / 365.25)", f"{f}_{k}") for k in (1, 2) for f in ("sin", "cos"))}
FROM tickets""",
)
def fourier(spark, d):
    terms = calendar.fourier_terms("date")
    return fx.tickets(spark, d).select("ticket_id", *[r6(c, n) for n, c in terms.items()])


@query(
    "x4_cyclical_terms",
    f"""WITH {fx.CELLS} SELECT event_id,
{s6("sin(2 * pi() * hour / 24)", "hour_sin")}, {s6("cos(2 * pi() * hour / 24)", "hour_cos")},
{s6("sin(2 * pi() * day_of_week / 7)", "dow_sin")}, {s6("cos(2 * pi() * day_of_week / 7)", "dow_cos")},
{s6("sin(2 * pi() * (month - 1) / 12)", "month_sin")}, {s6("cos(2 * pi() * (month - 1) / 12)", "month_cos")}
FROM cell_events""",
)
def cyclical(spark, d):
    terms = calendar.cyclical_terms(F.col("hour"), F.col("day_of_week"), F.col("month"))
    return fx.cell_events(spark, d).select("event_id", *[r6(c, n) for n, c in terms.items()])


@query(
    "x5_season_flag",
    f"""WITH {fx.TICKETS} SELECT ticket_id,
  CAST(CASE WHEN (month(date) = 3 AND day(date) >= 15) OR (month(date) = 4 AND day(date) <= 20) THEN 1 ELSE 0 END AS INTEGER) AS in_season
FROM tickets""",
)
def season(spark, d):
    return fx.tickets(spark, d).select("ticket_id", calendar.in_season(F.col("date")).cast("int").alias("in_season"))


@query(
    "x6_month_end_flag",
    f"""WITH {fx.TICKETS} SELECT ticket_id, day(date + 1) = 1 AS is_month_end FROM tickets""",
)
def month_end(spark, d):
    return fx.tickets(spark, d).select("ticket_id", calendar.is_month_end(F.col("date")).alias("is_month_end"))


_PRIORITY = "SELECT date, " + ", ".join(
    f"count(*) FILTER (WHERE violation = '{v}') AS \"{v}\"" for v in ("F", "O", "P")
) + " FROM tickets GROUP BY date"


@query(
    "x7_category_shares",
    f"""WITH {fx.TICKETS}, p AS ({_PRIORITY})
SELECT date, {", ".join(s6(f'"{v}" / ("F" + "O" + "P")', f"{v}_share") for v in ("F", "O", "P"))} FROM p""",
)
def category_shares(spark, d):
    p = aggregate.pivot_counts(fx.tickets(spark, d), ["date"], "violation", ["F", "O", "P"])
    return p.select("date", *[r6(c, n) for n, c in encode.shares(["F", "O", "P"]).items()])


@query(
    "x8_one_hot_weekday",
    f"""WITH {fx.TICKETS} SELECT ticket_id,
{", ".join(f"CAST(dayname(date) = '{n}' AS INTEGER) AS dow_{n}" for n in ("Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"))}
FROM tickets""",
)
def one_hot(spark, d):
    t = fx.tickets(spark, d).select("ticket_id", calendar.weekday_name(F.col("date")).alias("name"))
    return t.select("ticket_id", *[c.alias(n) for n, c in encode.one_hot(F.col("name"), calendar.WEEKDAYS, "dow").items()])


@query(
    "x9_grid_round",
    f"""WITH {fx.CELLS} SELECT event_id, CAST(round_even(latitude * 1000, 0) AS BIGINT) AS lat_grid,
  CAST(round_even(longitude * 1000, 0) AS BIGINT) AS lon_grid FROM cell_events""",
)
def grid_round(spark, d):
    return fx.cell_events(spark, d).select(
        "event_id", encode.grid_id(F.col("latitude")).alias("lat_grid"), encode.grid_id(F.col("longitude")).alias("lon_grid")
    )


_REM = "(CASE WHEN {c} % 0.001::DOUBLE < 0 THEN {c} % 0.001::DOUBLE + 0.001::DOUBLE ELSE {c} % 0.001::DOUBLE END)"


@query(
    "x10_grid_floor",
    f"""WITH {fx.CELLS} SELECT event_id,
  CAST(floor(latitude / 0.001::DOUBLE) AS BIGINT) AS lat_bin, CAST(floor(longitude / 0.001::DOUBLE) AS BIGINT) AS lon_bin,
  CAST(floor((latitude - {_REM.format(c="latitude")}) / 0.001::DOUBLE + 0.5) AS BIGINT) AS lat_bin_exact
FROM cell_events""",
)
def grid_floor(spark, d):
    return fx.cell_events(spark, d).select(
        "event_id",
        encode.grid_floor_id(F.col("latitude")).alias("lat_bin"),
        encode.grid_floor_id(F.col("longitude")).alias("lon_bin"),
        encode.grid_floor_id(F.col("latitude"), exact_multiple=True).alias("lat_bin_exact"),
    )


@query(
    "x11_minmax_scale",
    f"""WITH {fx.CELLS}, m AS (SELECT min(latitude) AS lo, max(latitude) AS hi FROM cell_events)
SELECT event_id, {s6("(latitude - lo) / greatest(1e-6, hi - lo) * 2 - 1", "lat_norm")} FROM cell_events, m""",
)
def minmax_scale(spark, d):
    e = fx.cell_events(spark, d)
    m = e.agg(F.struct(F.min("latitude").alias("lo"), F.max("latitude").alias("hi"))).scalar()
    return e.select("event_id", r6(encode.minmax(F.col("latitude"), m.getField("lo"), m.getField("hi")), "lat_norm"))


@query(
    "x12_standardize",
    f"""WITH {fx.DAILY}, m AS (SELECT avg(num_violations) AS a, stddev_pop(num_violations) AS s FROM daily)
SELECT series_id, date, {s6("(num_violations - a) / CASE WHEN s = 0 THEN 1 ELSE s END", "z")} FROM daily, m""",
)
def standardize(spark, d):
    x = fx.daily(spark, d)
    m = x.agg(F.struct(F.avg("num_violations").alias("a"), F.stddev_pop("num_violations").alias("s"))).scalar()
    return x.select("series_id", "date", r6(encode.standard(F.col("num_violations"), m.getField("a"), m.getField("s")), "z"))


@query(
    "x13_log_counts_and_back",
    f"""WITH {fx.DAILY}, m AS (SELECT ln(1 + greatest(1, max(num_violations))) + 2 AS cap FROM daily)
SELECT series_id, date, {s6("ln(1 + num_violations)", "log_y")},
  {s6("exp(least(ln(1 + num_violations) * 3, cap)) - 1", "back")} FROM daily, m""",
)
def log_counts(spark, d):
    x = fx.daily(spark, d)
    cap = x.agg(encode.log_cap(F.max("num_violations"))).scalar()
    y = F.log1p("num_violations")
    return x.select("series_id", "date", r6(y, "log_y"), r6(encode.unlog(y * 3, cap), "back"))


@query(
    "x15_zero_based_codes",
    f"""WITH {fx.TICKETS} SELECT ticket_id, CAST(month(date) - 1 AS INTEGER) AS month, CAST(day(date) - 1 AS INTEGER) AS day_of_month,
  CAST(least(greatest(weekofyear(date) - 1, 0), 52) AS INTEGER) AS week_of_year FROM tickets""",
)
def zero_based(spark, d):
    c = F.col("date")
    parts = {"month": F.month(c), "day_of_month": F.dayofmonth(c), "week_of_year": F.weekofyear(c)}
    return fx.tickets(spark, d).select("ticket_id", *[encode.zero_based(n, p).alias(n) for n, p in parts.items()])


@query(
    "x16_hour_floor",
    "SELECT event_id, date_trunc('hour', ts) AS hour_bin FROM events",
)
def hour_floor(spark, d):
    e = fx.table(spark, d, "events")
    return e.select("event_id", calendar.hour_floor(F.col("ts")).cast("timestamp_ntz").alias("hour_bin"))


@query(
    "x17_target_date",
    f"""WITH {fx.TICKETS} SELECT ticket_id, h AS horizon, CAST(date + h AS DATE) AS target_date
FROM tickets, (SELECT CAST(unnest([1, 3, 7]) AS INTEGER) AS h)""",
)
def target_dates(spark, d):
    t = fx.tickets(spark, d).select("ticket_id", "date", F.explode(F.array(F.lit(1), F.lit(3), F.lit(7))).alias("horizon"))
    return t.select("ticket_id", "horizon", calendar.target_date(F.col("date"), F.col("horizon")).alias("target_date"))


@query(
    "x18_hit_label",
    f"""WITH {fx.DAILY} SELECT series_id, date, CAST(num_violations > 0 AS INTEGER) AS label FROM daily""",
)
def label(spark, d):
    return fx.daily(spark, d).select("series_id", "date", encode.hit_label(F.col("num_violations")).alias("label"))


@query(
    "x19_residuals",
    f"""WITH {fx.PREDS} SELECT series_id, date, horizon, model, {s6("y_pred - y_true", "residual")},
  {s6("y_true - y_pred", "error")}, {s6("abs(y_pred - y_true)", "abs_err")} FROM preds""",
)
def residuals(spark, d):
    x = evaluate.residuals(fx.predictions(spark, d))
    return x.select("series_id", "date", "horizon", "model", r6("residual", "residual"), r6("error", "error"), r6("abs_err", "abs_err"))


@query(
    "x20_percent_gain",
    f"""WITH {fx.PREDS}, {fx.BOARD}
SELECT a.horizon, b.model, {s6("CASE WHEN a.mae > 0 THEN (a.mae - b.mae) / a.mae * 100 END", "gain")},
  {s6("abs(b.mae - a.mae)", "gap")}
FROM board a JOIN board b ON a.horizon = b.horizon AND a.model = 'last'""",
)
def percent_gain(spark, d):
    b = evaluate.summarize(fx.predictions(spark, d).where("split = 'test'"), ["horizon", "model"])
    base = b.where("model = 'last'").select("horizon", F.col("mae").alias("base"))
    x = b.join(base, "horizon")
    return x.select(
        "horizon", "model", r6(encode.pct_gain(F.col("base"), F.col("mae")), "gain"), r6(F.abs(F.col("mae") - F.col("base")), "gap")
    )


@query(
    "x21_report_rounding",
    "SELECT o_orderkey, round_even(o_totalprice / 1000 * 100, 0) / 100 AS thousands FROM orders",
)
def rounding(spark, d):
    return fx.table(spark, d, "orders").select("o_orderkey", encode.report_round(F.col("o_totalprice") / 1000).alias("thousands"))


@query(
    "x22_horizon_label",
    f"""WITH {fx.PREDS} SELECT horizon, 't+' || horizon AS label, count(*) AS n FROM preds GROUP BY horizon""",
)
def horizon_labels(spark, d):
    x = fx.predictions(spark, d).groupBy("horizon").agg(F.count(F.lit(1)).alias("n"))
    return x.select("horizon", calendar.horizon_label(F.col("horizon")).alias("label"), "n")
