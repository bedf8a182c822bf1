"""Header, type and row cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import encode, parse

# fixed values: date fields in the order they are tried
DATE_FIELDS = ["issue_datetime", "issue_date"]
DATE_PARTS = ["year", "month", "day"]

# fixed values: columns the cleaner drops, as nearly all their values are missing or unused
SPARSE_COLUMNS = ["vehicle_type", "disposition_desc", "disposition_date"]
UNUSED_COLUMNS = ["xcoord", "ycoord", "mar_id"]

UNKNOWN = "UNKNOWN"


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names without outer blanks, in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def event_time_column(df: DataFrame, infer: bool = False) -> Column:
    """The event time: a known field, else year, month and day, else (``infer``) a date-like name."""
    names = {c.lower(): c for c in df.columns}
    for field in DATE_FIELDS:
        if field in names:
            return parse.parse_ts(F.col(names[field]))
    if all(p in names for p in DATE_PARTS):
        y, m, d = (F.col(names[p]).cast("string") for p in DATE_PARTS)
        return F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")).try_cast("timestamp_ntz")
    if infer:
        def timed(c):
            return "issue" in c and "date" in c and "time" in c

        for test in (timed, lambda c: "date" in c):
            hits = [names[c] for c in names if test(c)]
            if hits:
                return parse.parse_ts(F.col(hits[0]))
    raise ValueError("no date field: expected issue_datetime, issue_date, or year, month and day")


def resolve_event_time(df: DataFrame, out: str = "event_ts", infer: bool = False) -> DataFrame:
    return df.withColumn(out, event_time_column(df, infer))


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in ``subset`` (all columns by default); NaN counts as null."""
    return df.dropna(subset=subset)


def where_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def fill_unknown(df: DataFrame, cols: list[str], value: str = UNKNOWN) -> DataFrame:
    return df.fillna(value, subset=cols)


def flag_not_null(df: DataFrame, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(col).isNotNull()).drop(col)


def to_numeric(df: DataFrame, cols: list[str], fill: float | None = None) -> DataFrame:
    return df.withColumns({c: parse.to_number(F.col(c), fill) for c in cols})


def bbox(df: DataFrame, lat: str = "latitude", lon: str = "longitude", box=encode.CITY_BOX) -> DataFrame:
    return df.where(encode.in_box(F.col(lat), F.col(lon), box))


def sanitize(df: DataFrame, cols: list[str], fill: float = 0.0) -> DataFrame:
    return df.withColumns({c: encode.finite(F.col(c), fill) for c in cols})


def top_location(df: DataFrame, col: str) -> DataFrame:
    """Rows of the busiest location; a tie goes to the smallest key.

    The key reaches the scan as a scalar subquery, so the rows are filtered, not joined.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.agg(F.min_by(col, F.struct(-F.col("_n"), F.col(col))).alias("_top"))
    return df.where(F.col(col) == best.scalar())


def relabel(df: DataFrame, col: str, mapping: dict[str, str]) -> DataFrame:
    """Replace listed values of ``col``, keep the rest."""
    c = F.col(col)
    for old, new in mapping.items():
        c = F.when(F.col(col) == old, F.lit(new)).otherwise(c)
    return df.withColumn(col, c)


# fixed value: model names that are not baselines
NEURAL_PATTERN = "tabnet|lstm|transformer"


def exclude_models(df: DataFrame, col: str = "model", pattern: str = NEURAL_PATTERN) -> DataFrame:
    return df.where(~F.col(col).rlike(f"(?i)({pattern})"))


def crop_dates(df: DataFrame, lo, hi, date: str = "date") -> DataFrame:
    """Rows from ``lo`` to ``hi``, both included."""
    return df.where(F.col(date).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))


def last_days(df: DataFrame, n: int, date: str = "date") -> DataFrame:
    """Rows at most ``n`` days before the last date."""
    latest = df.agg(F.date_sub(F.max(date), n))
    return df.where(F.col(date) >= latest.scalar())


def clean_events(raw: DataFrame) -> DataFrame:
    """The whole ticket cleaning in one narrow pass: no shuffle, columns pruned at the scan."""
    df = normalize_columns(raw)
    hour, minute = parse.hhmm(F.col("issue_time"))
    df = df.withColumns({"_day": parse.parse_ts(F.col("issue_date")), "_hour": hour, "_minute": minute})
    df = drop_nulls(df, ["_day", "_hour", "_minute", "latitude", "longitude"])
    df = df.withColumn("issue_datetime", parse.compose_datetime(F.col("_day"), F.col("_hour"), F.col("_minute")))
    present = [c for c in ("violation_proc_desc", "violation_type_desc") if c in df.columns]
    df = fill_unknown(df, present) if present else df
    if "multi_owner_number" in df.columns:
        df = flag_not_null(df, "multi_owner_number", "is_fleet_gov_or_rental")
    return df.drop("_day", "_hour", "_minute", "issue_date", "issue_time", *SPARSE_COLUMNS, *UNUSED_COLUMNS)
