"""Event, series, prediction and cell tables derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T  # noqa: F401
from pyspark.sql import Window

from ..functions.calendar import target_date
from ..operators.aggregate import daily_counts
from ..operators.densify import densify
from ..operators.splits import chrono_label
from ..operators.windows import rolling

TRAIN_END, VAL_END = "1999-12-31", "2000-12-31"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def tickets(spark: SparkSession, d: str) -> DataFrame:
    """Orders as ticket events."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_orderdate").alias("issue_ts"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("agency"),
        F.col("o_orderstatus").alias("violation"),
        F.col("o_custkey").alias("location_id"),
        F.col("o_totalprice").alias("amount"),
    )


TICKETS = """tickets AS (
  SELECT o_orderkey AS ticket_id, o_orderdate AS issue_ts, CAST(o_orderdate AS DATE) AS date,
         o_orderpriority AS agency, o_orderstatus AS violation, o_custkey AS location_id, o_totalprice AS amount
  FROM orders)"""


def shipments(spark: SparkSession, d: str) -> DataFrame:
    """Line items as events: the largest of the given tables."""
    return table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("agency"), F.col("l_linestatus").alias("violation")
    )


SHIPMENTS = """shipments AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS agency, l_linestatus AS violation FROM lineitem)"""


def daily(spark: SparkSession, d: str) -> DataFrame:
    """Gap-free daily counts per agency."""
    counts = daily_counts(tickets(spark, d).withColumnRenamed("agency", "series_id"), "date", ["series_id"])
    return densify(counts)


DAILY = TICKETS + """,
counts AS (SELECT agency AS series_id, date, count(*) AS num_violations FROM tickets GROUP BY agency, date),
span AS (SELECT series_id, min(date) AS lo, max(date) AS hi FROM counts GROUP BY series_id),
spine AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
daily AS (
  SELECT s.series_id, s.date, CAST(coalesce(c.num_violations, 0) AS BIGINT) AS num_violations, c.date IS NULL AS is_imputed
  FROM spine s LEFT JOIN counts c ON s.series_id = c.series_id AND s.date = c.date)"""


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Three plain forecasters over the daily series as the long prediction table."""
    rows = daily(spark, d).withColumn("y", F.col("num_violations").cast("double"))
    w = Window.partitionBy("series_id").orderBy("date")
    guesses = []
    for h in (1, 3, 7):
        truth = F.lead("y", h).over(w)
        seasonal = F.col("y") if h == 7 else F.lag("y", 7 - h).over(w)
        for model, guess in (("last", F.col("y")), ("seasonal", seasonal), ("mean7", rolling("y", 7, "mean", w))):
            guesses.append(
                F.struct(
                    F.lit(h).alias("horizon"), F.lit(model).alias("model"), truth.alias("y_true"), guess.alias("y_pred")
                )
            )
    long = rows.select("series_id", F.col("date").alias("made_on"), F.array(*guesses).alias("g")).select(
        "series_id", "made_on", F.inline("g")
    )
    long = long.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    long = long.withColumn("date", target_date(F.col("made_on"), F.col("horizon")))
    return long.select(
        "series_id", "date", "horizon", chrono_label(F.col("date"), TRAIN_END, VAL_END).alias("split"), "model", "y_true", "y_pred"
    )


def _preds_sql() -> str:
    parts = []
    for h in (1, 3, 7):
        for model, guess in (("last", "y"), ("seasonal", "y" if h == 7 else f"l{7 - h}"), ("mean7", "m7")):
            parts.append(
                f"SELECT series_id, date + {h} AS date, {h} AS horizon, '{model}' AS model, t{h} AS y_true, {guess} AS y_pred FROM ordered"
            )
    return (
        DAILY
        + """,
base AS (SELECT series_id, date, CAST(num_violations AS DOUBLE) AS y FROM daily),
ordered AS (
  SELECT series_id, date, y,
         CASE WHEN count(y) OVER f7 >= 7 THEN avg(y) OVER f7 END AS m7,
         lag(y, 6) OVER o AS l6, lag(y, 4) OVER o AS l4,
         lead(y, 1) OVER o AS t1, lead(y, 3) OVER o AS t3, lead(y, 7) OVER o AS t7
  FROM base
  WINDOW o AS (PARTITION BY series_id ORDER BY date),
         f7 AS (PARTITION BY series_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
preds AS (
  SELECT series_id, CAST(date AS DATE) AS date, CAST(horizon AS INTEGER) AS horizon,
         CASE WHEN date <= DATE '1999-12-31' THEN 'train' WHEN date <= DATE '2000-12-31' THEN 'val' ELSE 'test' END AS split,
         model, y_true, y_pred
  FROM ("""
        + "\n    UNION ALL ".join(parts)
        + """)
  WHERE y_true IS NOT NULL AND y_pred IS NOT NULL)"""
    )


PREDS = _preds_sql()

BOARD = """board AS (
  SELECT horizon, model, avg(abs(y_true - y_pred)) AS mae, sqrt(avg(power(y_true - y_pred, 2))) AS rmse,
         avg(CASE WHEN abs(y_true) > 1e-8 THEN abs(y_true - y_pred) / abs(y_true) END) * 100 AS mape
  FROM preds WHERE split = 'test' GROUP BY horizon, model)"""


def cell_events(spark: SparkSession, d: str) -> DataFrame:
    """Events placed on the city grid; ids are thousandths of a degree."""
    e = table(spark, d, "events")
    lat_id = 38780 + F.pmod(F.col("user_id") * 37, F.lit(250))
    lon_id = -77120 + F.pmod(F.col("user_id") * 53, F.lit(220))
    off = F.pmod(F.col("event_id"), F.lit(7)) * F.lit(0.00001)
    return e.select(
        "event_id",
        "ts",
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_bin"),
        F.weekday("ts").alias("day_of_week"),
        F.month("ts").alias("month"),
        lat_id.alias("lat_id"),
        lon_id.alias("lon_id"),
        (lat_id / F.lit(1000.0) + off).alias("latitude"),
        (lon_id / F.lit(1000.0) + off).alias("longitude"),
        "event_type",
        "value",
    )


CELLS = """cell_events AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, date_trunc('hour', ts) AS hour_bin,
         CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month,
         38780 + (user_id * 37) % 250 AS lat_id, -77120 + (user_id * 53) % 220 AS lon_id,
         (38780 + (user_id * 37) % 250) / CAST(1000 AS DOUBLE) + (event_id % 7) * CAST(0.00001 AS DOUBLE) AS latitude,
         (-77120 + (user_id * 53) % 220) / CAST(1000 AS DOUBLE) + (event_id % 7) * CAST(0.00001 AS DOUBLE) AS longitude,
         event_type, value
  FROM events)"""


def key_hash_sql(*keys: str, seed: int = 42) -> str:
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts}, '{seed}')), 1, 13) AS BIGINT)"


# all rule-made holidays of the years in use, found by counting weekdays instead of day ranges
HOLIDAYS = """days AS (SELECT CAST(unnest(generate_series(DATE '1994-12-01', DATE '2025-01-31', INTERVAL 1 DAY)) AS DATE) AS d),
nth AS (
  SELECT d, year(d) AS y, month(d) AS m, day(d) AS dd, isodow(d) AS wd,
         row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d) AS up,
         row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d DESC) AS down
  FROM days),
fixed_days AS (
  SELECT d, wd FROM nth
  WHERE (m = 1 AND dd = 1) OR (m = 6 AND dd = 19 AND y >= 2021) OR (m = 7 AND dd = 4) OR (m = 11 AND dd = 11) OR (m = 12 AND dd = 25)),
holidays AS (
  SELECT d FROM fixed_days
  UNION SELECT CAST(d - 1 AS DATE) FROM fixed_days WHERE wd = 6
  UNION SELECT CAST(d + 1 AS DATE) FROM fixed_days WHERE wd = 7
  UNION SELECT d FROM nth
  WHERE (m = 1 AND wd = 1 AND up = 3) OR (m = 2 AND wd = 1 AND up = 3) OR (m = 5 AND wd = 1 AND down = 1)
     OR (m = 9 AND wd = 1 AND up = 1) OR (m = 10 AND wd = 1 AND up = 2) OR (m = 11 AND wd = 4 AND up = 4))"""
