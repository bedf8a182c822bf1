"""Cleaning, filters and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parse
from ..operators import clean, profile
from . import fixtures as fx
from .registry import query, r6, s6


def raw_text(spark, d):
    """Events as messy text: padded mixed-case headers, bad dates and clock values, missing fields."""
    e = fx.table(spark, d, "events")
    k = F.col("event_id")
    return e.select(
        k.alias(" Event_ID "),
        F.when(k % 97 == 0, "not a date").when(k % 89 == 0, None).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias(" Issue_Date "),
        F.when(k % 83 == 0, 2560).when(k % 79 == 0, None).otherwise(F.hour("ts") * 100 + F.minute("ts")).alias("ISSUE_TIME"),
        F.when(k % 11 == 0, None).otherwise(F.col("event_type")).alias("VIOLATION_TYPE_DESC"),
        F.when(k % 7 == 0, F.col("user_id")).alias("MULTI_OWNER_NUMBER"),
        F.when(k % 53 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("VALUE_TEXT"),
        F.when(k % 13 == 0, None).otherwise(38.7 + F.col("user_id") * 0.003).alias("LATITUDE"),
        F.when(k % 17 == 0, None).otherwise(-77.2 + F.col("user_id") * 0.003).alias("LONGITUDE"),
        F.lit(None).cast("string").alias("DISPOSITION_DESC"),
    )


RAW = """raw AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE date_trunc('second', ts) END AS issue_date,
    CASE WHEN event_id % 97 = 0 THEN 'not a date' WHEN event_id % 89 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS issue_text,
    CASE WHEN event_id % 83 = 0 THEN 2560 WHEN event_id % 79 = 0 THEN NULL ELSE hour(ts) * 100 + minute(ts) END AS issue_time,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS violation_type_desc,
    CASE WHEN event_id % 7 = 0 THEN user_id END AS multi_owner_number,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE value END AS value_num,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(38.7 AS DOUBLE) + user_id * CAST(0.003 AS DOUBLE) END AS latitude,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(-77.2 AS DOUBLE) + user_id * CAST(0.003 AS DOUBLE) END AS longitude
  FROM events)"""


def norm(spark, d):
    return clean.normalize_columns(raw_text(spark, d))


@query("b1_normalize_columns", f"WITH {RAW} SELECT event_id, issue_text AS issue_date, CAST(issue_time AS INTEGER) AS issue_time FROM raw")
def normalize(spark, d):
    return norm(spark, d).select("event_id", "issue_date", "issue_time")


@query("b2_resolve_event_time", f"WITH {RAW} SELECT event_id, issue_date AS event_ts FROM raw")
def resolve(spark, d):
    return clean.resolve_event_time(norm(spark, d)).select("event_id", "event_ts")


@query("b2_event_time_from_parts", f"WITH {fx.TICKETS} SELECT ticket_id, CAST(date AS TIMESTAMP) AS event_ts FROM tickets")
def resolve_parts(spark, d):
    t = fx.tickets(spark, d)
    parts = t.select("ticket_id", F.year("date").alias("Year"), F.month("date").alias("MONTH"), F.dayofmonth("date").alias("day"))
    return clean.resolve_event_time(parts).select("ticket_id", "event_ts")


@query("b3_parse_timestamp", f"WITH {RAW} SELECT event_id, issue_date AS parsed, issue_date AS by_format FROM raw")
def parse_timestamp(spark, d):
    c = F.col("issue_date")
    return norm(spark, d).select(
        "event_id", parse.parse_ts(c).alias("parsed"), parse.parse_ts(c, ("yyyy-MM-dd HH:mm:ss",)).alias("by_format")
    )


@query("b4_strip_zone", "SELECT event_id, ts AS local_ts FROM events")
def strip_zone(spark, d):
    e = fx.table(spark, d, "events")
    return e.select("event_id", parse.strip_zone(F.col("ts").cast("timestamp")).alias("local_ts"))


@query(
    "b5_parse_hhmm",
    f"""WITH {RAW} SELECT event_id, CAST(CASE WHEN issue_time < 2400 THEN issue_time // 100 END AS INTEGER) AS hour,
  CAST(CASE WHEN issue_time < 2400 THEN issue_time % 100 END AS INTEGER) AS minute FROM raw""",
)
def hhmm(spark, d):
    h, m = parse.hhmm(F.col("issue_time"))
    return norm(spark, d).select("event_id", h.alias("hour"), m.alias("minute"))


@query(
    "b6_compose_datetime",
    f"""WITH {RAW} SELECT event_id, date_trunc('day', issue_date) + to_minutes(CAST(issue_time // 100 * 60 + issue_time % 100 AS BIGINT)) AS issue_datetime
FROM raw WHERE issue_date IS NOT NULL AND issue_time < 2400""",
)
def compose(spark, d):
    h, m = parse.hhmm(F.col("issue_time"))
    x = clean.resolve_event_time(norm(spark, d)).withColumns({"h": h, "m": m})
    x = clean.drop_nulls(x, ["event_ts", "h", "m"])
    return x.select("event_id", parse.compose_datetime(F.col("event_ts"), F.col("h"), F.col("m")).alias("issue_datetime"))


@query("b7_drop_invalid", f"WITH {RAW} SELECT event_id FROM raw WHERE issue_date IS NOT NULL AND issue_time IS NOT NULL AND issue_time < 2400")
def drop_invalid(spark, d):
    h, m = parse.hhmm(F.col("issue_time"))
    x = clean.resolve_event_time(norm(spark, d)).withColumns({"h": h, "m": m})
    return clean.drop_nulls(x, ["event_ts", "h", "m"]).select("event_id")


@query(
    "b8_drop_nulls",
    f"""WITH {RAW} SELECT event_id, {s6("latitude", "latitude")}, {s6("longitude", "longitude")} FROM raw
WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
)
def drop_nulls(spark, d):
    x = clean.drop_nulls(norm(spark, d), ["latitude", "longitude"])
    return x.select("event_id", r6("latitude", "latitude"), r6("longitude", "longitude"))


@query("b9_find_null_times", f"WITH {RAW} SELECT event_id FROM raw WHERE issue_date IS NULL")
def null_times(spark, d):
    return clean.where_null(clean.resolve_event_time(norm(spark, d)), "event_ts").select("event_id")


@query("b10_fill_unknown", f"WITH {RAW} SELECT event_id, coalesce(violation_type_desc, 'UNKNOWN') AS violation_type_desc FROM raw")
def fill_unknown(spark, d):
    return clean.fill_unknown(norm(spark, d), ["violation_type_desc"]).select("event_id", "violation_type_desc")


@query("b11_flag_not_null", f"WITH {RAW} SELECT event_id, multi_owner_number IS NOT NULL AS is_fleet_gov_or_rental FROM raw")
def flag(spark, d):
    return clean.flag_not_null(norm(spark, d), "multi_owner_number", "is_fleet_gov_or_rental").select("event_id", "is_fleet_gov_or_rental")


@query(
    "b12_clean_events",
    f"""WITH {RAW} SELECT event_id, date_trunc('day', issue_date) + to_minutes(CAST(issue_time // 100 * 60 + issue_time % 100 AS BIGINT)) AS issue_datetime,
  coalesce(violation_type_desc, 'UNKNOWN') AS violation_type_desc, multi_owner_number IS NOT NULL AS is_fleet_gov_or_rental
FROM raw WHERE issue_date IS NOT NULL AND issue_time < 2400 AND latitude IS NOT NULL AND longitude IS NOT NULL""",
)
def clean_all(spark, d):
    x = clean.clean_events(raw_text(spark, d))
    return x.drop("value_text", "latitude", "longitude")


@query(
    "b13_to_numeric",
    f"WITH {RAW} SELECT event_id, {s6('value_num', 'value_num')}, {s6('coalesce(value_num, 0)', 'value_filled')} FROM raw",
)
def to_numeric(spark, d):
    c = F.col("value_text")
    return norm(spark, d).select("event_id", r6(parse.to_number(c), "value_num"), r6(parse.to_number(c, 0), "value_filled"))


@query(
    "b14_bounding_box",
    f"WITH {RAW} SELECT event_id FROM raw WHERE latitude BETWEEN 38.78 AND 39.03 AND longitude BETWEEN -77.12 AND -76.90",
)
def bounding_box(spark, d):
    return clean.bbox(norm(spark, d)).select("event_id")


@query(
    "b15_sanitize",
    """SELECT event_id, round(CASE WHEN event_id % 5 IN (0, 1, 2, 3) THEN 0 ELSE value END, 6) + 0.0 AS value FROM events""",
)
def sanitize(spark, d):
    k = F.col("event_id") % 5
    bad = (
        F.when(k == 0, float("inf")).when(k == 1, float("-inf")).when(k == 2, float("nan")).when(k == 3, None).otherwise(F.col("value"))
    )
    x = fx.table(spark, d, "events").select("event_id", bad.alias("value"))
    return clean.sanitize(x, ["value"]).select("event_id", r6("value", "value"))


@query(
    "b17_top_location",
    f"""WITH {fx.TICKETS}, top AS (SELECT location_id FROM tickets GROUP BY 1 ORDER BY count(*) DESC, location_id LIMIT 1)
SELECT ticket_id, location_id FROM tickets WHERE location_id = (SELECT location_id FROM top)""",
)
def top_location(spark, d):
    return clean.top_location(fx.tickets(spark, d).select("ticket_id", "location_id"), "location_id")


@query(
    "b18_relabel",
    f"""WITH {fx.PREDS} SELECT CASE model WHEN 'last' THEN 'Last value' WHEN 'mean7' THEN 'Weekly mean' ELSE model END AS model,
  count(*) AS n FROM preds GROUP BY 1""",
)
def relabel(spark, d):
    x = clean.relabel(fx.predictions(spark, d), "model", {"last": "Last value", "mean7": "Weekly mean"})
    return x.groupBy("model").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b19_exclude_models",
    f"""WITH {fx.PREDS} SELECT series_id, date, horizon, model, y_pred FROM preds WHERE model NOT LIKE '%season%' AND split = 'test'""",
)
def exclude(spark, d):
    x = fx.predictions(spark, d).where("split = 'test'")
    return clean.exclude_models(x, pattern="SEASON|lstm").select("series_id", "date", "horizon", "model", "y_pred")


@query("b20_membership", f"WITH {fx.TICKETS} SELECT ticket_id, agency FROM tickets WHERE agency IN ('1-URGENT', '2-HIGH')")
def membership(spark, d):
    return fx.tickets(spark, d).where(F.col("agency").isin("1-URGENT", "2-HIGH")).select("ticket_id", "agency")


@query(
    "b21_last_90_days",
    f"""WITH {fx.TICKETS} SELECT ticket_id, date FROM tickets WHERE date >= (SELECT max(date) - 90 FROM tickets)""",
)
def last_90(spark, d):
    return clean.last_days(fx.tickets(spark, d).select("ticket_id", "date"), 90)


@query(
    "b21_crop_dates",
    f"""WITH {fx.TICKETS} SELECT ticket_id, date FROM tickets WHERE date BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'""",
)
def crop(spark, d):
    return clean.crop_dates(fx.tickets(spark, d).select("ticket_id", "date"), "1997-03-01", "1998-02-28")


@query("b22_split_horizon_filter", f"WITH {fx.PREDS} SELECT series_id, date, model, y_true, y_pred FROM preds WHERE split = 'test' AND horizon = 1")
def split_filter(spark, d):
    x = fx.predictions(spark, d).where((F.col("split") == "test") & (F.col("horizon") == 1))
    return x.select("series_id", "date", "model", "y_true", "y_pred")


_COLS = ["event_id", "issue_date", "issue_time", "violation_type_desc", "multi_owner_number", "latitude", "longitude"]


def _profiled(spark, d):
    return norm(spark, d).select(*_COLS)


def _sql_col(c):
    return "issue_text" if c == "issue_date" else c


@query(
    "p1_null_profile",
    f"WITH {RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({_sql_col(c)}) AS non_null, count(*) - count({_sql_col(c)}) AS nulls FROM raw" for c in _COLS
    ),
)
def null_profile(spark, d):
    return profile.profile_nulls(_profiled(spark, d))


_TYPES = dict(zip(_COLS, ["bigint", "string", "int", "string", "bigint", "double", "double"]))


@query(
    "p2_profile",
    f"WITH {RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{_TYPES[c]}' AS dtype, count(*) - count({_sql_col(c)}) AS nulls, "
        f"count(DISTINCT {_sql_col(c)}) AS distinct_values FROM raw"
        for c in _COLS
    ),
)
def full_profile(spark, d):
    return profile.profile(_profiled(spark, d))


@query(
    "p3_duplicate_count",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_returnflag, l_quantity)",
)
def duplicates(spark, d):
    return profile.duplicate_count(fx.table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_quantity"))


@query("p4_value_counts", f"WITH {RAW} SELECT violation_type_desc, count(*) AS n FROM raw GROUP BY 1")
def value_counts(spark, d):
    return profile.value_counts(norm(spark, d), "violation_type_desc")


@query("p5_time_range", "SELECT min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem")
def time_range(spark, d):
    return profile.time_range(fx.table(spark, d, "lineitem"), "l_shipdate")


@query("p6_row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, d):
    return profile.row_count(fx.table(spark, d, "lineitem"))


@query("p6_preview", "SELECT event_id, ts, event_type FROM events ORDER BY ts, event_id LIMIT 5")
def preview(spark, d):
    return profile.preview(fx.table(spark, d, "events").select("event_id", "ts", "event_type"), ["ts", "event_id"], 5)

