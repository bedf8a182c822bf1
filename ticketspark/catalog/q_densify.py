"""Gap filling, resampling, grids and future dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar
from ..operators import aggregate, densify
from . import fixtures as fx
from .registry import query, r6, s6


@query("c1_daily_gap_fill", f"WITH {fx.DAILY} SELECT series_id, date, num_violations, is_imputed FROM daily")
def gap_fill(spark, d):
    return fx.daily(spark, d)


@query(
    "c1_daily_gap_fill_common_span",
    f"""WITH {fx.TICKETS},
counts AS (SELECT location_id % 50 AS series_id, date, count(*) AS num_violations FROM tickets GROUP BY 1, 2),
keys AS (SELECT DISTINCT series_id FROM counts),
spine AS (SELECT CAST(unnest(generate_series((SELECT min(date) FROM counts), (SELECT max(date) FROM counts), INTERVAL 1 DAY)) AS DATE) AS date)
SELECT k.series_id, s.date, CAST(coalesce(c.num_violations, 0) AS BIGINT) AS num_violations, c.date IS NULL AS is_imputed
FROM keys k CROSS JOIN spine s LEFT JOIN counts c ON k.series_id = c.series_id AND s.date = c.date""",
)
def gap_fill_common(spark, d):
    t = fx.tickets(spark, d).select("date", (F.col("location_id") % 50).alias("series_id"))
    return densify.densify(aggregate.daily_counts(t, "date", ["series_id"]), span="all")


_HOURLY = """c AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, count(*) AS n FROM events GROUP BY 1, 2),
r AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM c GROUP BY 1),
s AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM r)"""


@query(
    "c2_resample_hourly",
    f"WITH {_HOURLY} SELECT s.series_id, s.ts, CAST(coalesce(n, 0) AS DOUBLE) AS y FROM s LEFT JOIN c ON s.series_id = c.series_id AND s.ts = c.ts",
)
def resample_hourly(spark, d):
    e = fx.table(spark, d, "events").select("ts", F.col("event_type").alias("series_id"))
    return densify.resample_counts(e, "ts", "hour")


@query(
    "c2_resample_daily_shipments",
    f"""WITH {fx.SHIPMENTS}, c AS (SELECT agency AS series_id, date AS ts, count(*) AS n FROM shipments GROUP BY 1, 2),
r AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM c GROUP BY 1),
s AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ts FROM r)
SELECT s.series_id, s.ts, CAST(coalesce(n, 0) AS DOUBLE) AS y FROM s LEFT JOIN c ON s.series_id = c.series_id AND s.ts = c.ts""",
)
def resample_daily(spark, d):
    return densify.resample_counts(fx.shipments(spark, d).withColumnRenamed("agency", "series_id"), "date", "day")


@query("c3_missing_days", f"WITH {fx.DAILY} SELECT series_id, date FROM daily WHERE is_imputed")
def missing_days(spark, d):
    t = fx.tickets(spark, d).withColumnRenamed("agency", "series_id")
    return densify.missing_periods(aggregate.daily_counts(t, "date", ["series_id"]))


@query(
    "c3_missing_weeks",
    f"""WITH {fx.TICKETS}, c AS (SELECT location_id, CAST(date_trunc('week', date) AS DATE) AS week FROM tickets GROUP BY 1, 2),
r AS (SELECT location_id, min(week) AS lo, max(week) AS hi FROM c GROUP BY 1),
s AS (SELECT location_id, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week FROM r)
SELECT location_id, week FROM s ANTI JOIN c USING (location_id, week)""",
)
def missing_weeks(spark, d):
    weeks = fx.tickets(spark, d).select("location_id", calendar.week_start(F.col("date")).alias("week")).distinct()
    return densify.missing_periods(weeks, "week", ["location_id"], "week")


@query(
    "c4_as_daily_frequency",
    f"WITH {fx.DAILY} SELECT series_id, date, CASE WHEN NOT is_imputed THEN num_violations END AS num_violations FROM daily",
)
def as_freq(spark, d):
    t = fx.tickets(spark, d).withColumnRenamed("agency", "series_id")
    return densify.as_freq(aggregate.daily_counts(t, "date", ["series_id"]))


@query(
    "c5_space_time_grid",
    f"""WITH {fx.CELLS},
e AS (SELECT *, lat_id // 25 AS lat_bin, CAST(floor(lon_id / 22.0) AS BIGINT) AS lon_bin FROM cell_events),
hits AS (SELECT hour_bin, lat_bin, lon_bin, count(*) AS n FROM e GROUP BY 1, 2, 3),
h AS (SELECT unnest(generate_series(min(hour_bin), max(hour_bin), INTERVAL 1 HOUR)) AS hour_bin FROM hits),
grid AS (SELECT * FROM h, (SELECT DISTINCT lat_bin FROM hits), (SELECT DISTINCT lon_bin FROM hits)),
full_grid AS (SELECT g.hour_bin, g.lat_bin AS lat_id, g.lon_bin AS lon_id, coalesce(n, 0) AS ticket_count
  FROM grid g LEFT JOIN hits USING (hour_bin, lat_bin, lon_bin))
SELECT hour_bin, lat_id, lon_id, CAST(ticket_count AS BIGINT) AS ticket_count, CAST(ticket_count > 0 AS INTEGER) AS label FROM full_grid""",
)
def space_time(spark, d):
    """Cells of 25 by 22 thousandths, which keeps the product readable."""
    e = fx.cell_events(spark, d).withColumns(
        {"lat_id": F.floor(F.col("lat_id") / 25).cast("long"), "lon_id": F.floor(F.col("lon_id") / 22).cast("long")}
    )
    hits = aggregate.cell_counts(e, ["hour_bin", "lat_id", "lon_id"])
    return densify.space_time_grid(hits)


_VISITED = fx.CELLS + """,
hits AS (SELECT date, lat_id, lon_id, hour, count(*) AS n FROM cell_events GROUP BY 1, 2, 3, 4),
visited AS (SELECT v.date, v.lat_id, v.lon_id, CAST(h AS INTEGER) AS hour
  FROM (SELECT DISTINCT date, lat_id, lon_id FROM hits) v, range(24) r(h)),
samples AS (SELECT v.date, v.lat_id, v.lon_id, v.hour, CAST(coalesce(n, 0) AS BIGINT) AS ticket_count,
    CAST(coalesce(n, 0) > 0 AS INTEGER) AS label
  FROM visited v LEFT JOIN hits h ON v.date = h.date AND v.lat_id = h.lat_id AND v.lon_id = h.lon_id AND v.hour = h.hour)"""


@query("c6_visited_cell_hours", f"WITH {_VISITED} SELECT date, lat_id, lon_id, hour, ticket_count, label FROM samples")
def visited(spark, d):
    return densify.visited_grid(fx.cell_events(spark, d))


@query(
    "c7_future_dates",
    f"""WITH {fx.DAILY}, m AS (SELECT series_id, max(date) AS last FROM daily GROUP BY 1)
SELECT series_id, CAST(last + k AS DATE) AS date FROM m, (SELECT CAST(unnest(generate_series(1, 14)) AS INTEGER) AS k)""",
)
def future(spark, d):
    t = fx.tickets(spark, d).withColumnRenamed("agency", "series_id")
    return densify.future_dates(t, 14)


@query(
    "c8_future_features",
    f"""WITH {fx.DAILY}, m AS (SELECT series_id, min(date) AS lo, max(date) AS last FROM daily GROUP BY 1)
SELECT series_id, CAST(last + k AS DATE) AS date, CAST(isodow(last + k) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(last + k) >= 6 AS INTEGER) AS is_weekend, CAST(month(last + k) AS INTEGER) AS month,
  CAST(last + k - lo AS INTEGER) AS days_since_start, CAST(0 AS DOUBLE) AS agency_1, CAST(0 AS DOUBLE) AS lag_1
FROM m, (SELECT CAST(unnest(generate_series(1, 7)) AS INTEGER) AS k)""",
)
def future_features(spark, d):
    t = fx.tickets(spark, d).withColumnRenamed("agency", "series_id")
    starts = t.groupBy("series_id").agg(F.min("date").alias("start"))
    dates = densify.future_dates(t, 7).join(starts, "series_id")
    c = F.col("date")
    known = {
        "day_of_week": F.weekday(c),
        "is_weekend": calendar.is_weekend(c).cast("int"),
        "month": F.month(c),
        "days_since_start": F.date_diff(c, F.col("start")),
    }
    columns = ["day_of_week", "is_weekend", "agency_1", "month", "days_since_start", "lag_1"]
    return densify.future_features(dates, columns, known, ["series_id", "date"])
