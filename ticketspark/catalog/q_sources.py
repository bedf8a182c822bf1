"""Readers and writers, fed with files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import sources
from ..functions.encode import grid_id
from ..operators import aggregate, spatial
from ..session import scratch_path
from . import fixtures as fx
from .registry import query, r6, s6

_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("ticket_id", T.LongType()),
        T.StructField("issue_date", T.DateType()),
        T.StructField("agency", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("location_id", T.LongType()),
    ]
)


@query(
    "a1_read_csv_folder",
    f"""WITH {fx.TICKETS} SELECT ticket_id, date AS issue_date, agency, {s6("amount", "amount")},
  CASE WHEN violation = 'O' THEN NULL ELSE location_id END AS location_id FROM tickets""",
)
def read_folder(spark, d):
    """Two sets of files with different columns, order and header case."""
    t = fx.tickets(spark, d)
    path = scratch_path(spark, "csv-events")
    one = t.where("violation != 'O'").select(
        F.col("ticket_id").alias(" Ticket_ID "), F.col("date").alias("Issue_Date"), F.col("agency").alias("AGENCY"), "amount", "location_id"
    )
    two = t.where("violation = 'O'").select("amount", "agency", F.col("date").alias("issue_date"), "ticket_id")
    one.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(f"{path}/a")
    two.write.option("header", True).csv(f"{path}/b")
    x = sources.read_events(spark, f"{path}/*/*.csv", _EVENT_SCHEMA)
    return x.select("ticket_id", "issue_date", "agency", r6("amount", "amount"), "location_id")


_DAILY_SCHEMA = T.StructType(
    [T.StructField("series_id", T.StringType()), T.StructField("date", T.DateType()), T.StructField("num_violations", T.LongType())]
)


@query("a3_read_daily_csv", f"WITH {fx.DAILY} SELECT series_id, date, num_violations FROM daily")
def read_daily(spark, d):
    path = scratch_path(spark, "csv-daily")
    sources.write_table(fx.daily(spark, d).select("series_id", "date", "num_violations"), path, "csv")
    return sources.read_daily(spark, path, _DAILY_SCHEMA)


@query(
    "a5_read_predictions",
    f"""WITH {fx.PREDS} SELECT series_id, date, horizon, split, model, {s6("y_true", "y_true")}, {s6("y_pred", "y_pred")} FROM preds""",
)
def read_predictions(spark, d):
    """Day-ahead files carry no horizon column."""
    path = scratch_path(spark, "csv-predictions")
    p = fx.predictions(spark, d)
    p.where("horizon = 1").drop("horizon").write.option("header", True).csv(f"{path}/predictions_day")
    p.where("horizon > 1").write.option("header", True).csv(f"{path}/predictions_later")
    x = sources.read_predictions(spark, f"{path}/predictions_*/*.csv")
    return x.select("series_id", "date", "horizon", "split", "model", r6("y_true", "y_true"), r6("y_pred", "y_pred"))


@query(
    "a6_read_artefact",
    f"WITH {fx.PREDS}, {fx.BOARD} SELECT horizon, model, {s6('mae', 'mae')}, {s6('rmse', 'rmse')} FROM board",
)
def read_artefact(spark, d):
    from ..operators.evaluate import summarize

    path = scratch_path(spark, "leaderboard")
    board = summarize(fx.predictions(spark, d).where("split = 'test'"), ["horizon", "model"])
    sources.write_table(board, path)
    x = sources.read_table(spark, path)
    return x.select("horizon", "model", r6("mae", "mae"), r6("rmse", "rmse"))


@query(
    "a7_write_partitioned",
    f"""WITH {fx.TICKETS} SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, ticket_id, agency FROM tickets""",
)
def write_partitioned(spark, d):
    t = fx.tickets(spark, d).select(F.year("date").alias("year"), F.month("date").alias("month"), "ticket_id", "agency")
    path = sources.write_table(t, scratch_path(spark, "tickets"), partition_by=["year", "month"])
    return sources.read_table(spark, path).select("year", "month", "ticket_id", "agency")


@query(
    "a9_feature_metadata",
    f"""WITH {fx.CELLS}, c AS (SELECT count(*) AS cells FROM (SELECT DISTINCT lat_id, lon_id FROM cell_events)),
m AS (SELECT month FROM cell_events GROUP BY month ORDER BY count(*) DESC, month LIMIT 1)
SELECT {s6("min(latitude)", "lat_min")}, {s6("max(latitude)", "lat_max")}, {s6("min(longitude)", "lon_min")}, {s6("max(longitude)", "lon_max")},
  (SELECT cells FROM c) AS cells, (SELECT month FROM m) AS month_mode FROM cell_events""",
)
def metadata(spark, d):
    e = fx.cell_events(spark, d).withColumns({"lat_id": grid_id(F.col("latitude")), "lon_id": grid_id(F.col("longitude"))})
    path = sources.save_meta(
        scratch_path(spark, "meta"),
        aggregate.feature_ranges(e, ["latitude", "longitude"]),
        spatial.cell_ids(e),
        aggregate.mode_value(e, "month"),
    )
    meta = sources.load_meta(spark, path)
    r = meta["ranges"]

    def end(column, side):
        return r.where(F.col("column") == column).agg(F.max(side)).scalar()

    ends = {
        "lat_min": end("latitude", "lo"),
        "lat_max": end("latitude", "hi"),
        "lon_min": end("longitude", "lo"),
        "lon_max": end("longitude", "hi"),
    }
    cells = meta["cells"].agg(F.count(F.lit(1))).scalar()
    return meta["modes"].select(*[r6(c, n) for n, c in ends.items()], cells.alias("cells"), F.col("month_mode"))
