"""Gap filling and grids.

A series is completed from its own rows: each row looks at the next one and writes out the steps in
between. That takes a single shuffle by series, and no calendar table to join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import spread

_DAYS = {"day": 1, "week": 7}


def _shift(c: Column, step: str, sign: int) -> Column:
    if step == "hour":
        hour = F.make_dt_interval(F.lit(0), F.lit(1))
        return c + hour if sign > 0 else c - hour
    return F.date_add(c, sign * _DAYS[step])


def _steps(lo: Column, hi: Column, step: str) -> Column:
    every = "INTERVAL 1 HOUR" if step == "hour" else f"INTERVAL {_DAYS[step]} DAY"
    return F.sequence(lo, hi, F.expr(every))


def densify(
    df: DataFrame,
    date: str = "date",
    by: Sequence[str] = ("series_id",),
    fill: float | None = 0,
    step: str = "day",
    span: str = "series",
) -> DataFrame:
    """Every step from the first to the last row of each series, one row per step.

    ``df`` holds one row per series and step. Added rows carry ``is_imputed``; their numbers, and
    nulls in the given rows, become ``fill`` (null when ``fill`` is None). ``span="all"`` stretches
    every series over the range of the whole table.
    """
    w = Window.partitionBy(*by).orderBy(date)
    here, following = F.col(date), F.lead(date).over(w)
    lo, hi = here, F.greatest(_shift(following, step, -1), here)
    wide = df
    if span == "all":
        bounds = df.agg(F.struct(F.min(date).alias("lo"), F.max(date).alias("hi"))).scalar()
        wide = df.withColumn("_bounds", bounds)
        lo = F.when(F.lag(date).over(w).isNull(), F.col("_bounds.lo")).otherwise(here)
        hi = F.when(following.isNull(), F.col("_bounds.hi")).otherwise(hi)
    else:
        hi = F.coalesce(hi, here)
    wide = wide.withColumns({"_lo": lo, "_hi": hi})
    rows = wide.withColumn("_step", F.explode(_steps(F.col("_lo"), F.col("_hi"), step)))
    added = F.col("_step") != F.col(date)
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if field.name == date:
            out.append(F.col("_step").alias(date))
        elif field.name in by:
            out.append(c)
        elif fill is not None and isinstance(field.dataType, T.NumericType):
            zero = F.lit(fill).cast(field.dataType)
            out.append(F.when(added, zero).otherwise(F.coalesce(c, zero)).alias(field.name))
        else:
            out.append(F.when(~added, c).alias(field.name))
    return rows.select(*out, added.alias("is_imputed"))


def as_freq(df: DataFrame, date: str = "date", by: Sequence[str] = ("series_id",), step: str = "day") -> DataFrame:
    """One row per step, with nulls on the added rows."""
    return densify(df, date, by, fill=None, step=step).drop("is_imputed")


def resample_counts(df: DataFrame, ts: str, freq: str = "day", by: Sequence[str] = ("series_id",), out: str = "y") -> DataFrame:
    """Events per day or hour with zeros for empty steps, as doubles."""
    unit = F.to_date(ts) if freq == "day" else F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    counts = df.groupBy(*by, unit.alias("ts")).agg(F.count(F.lit(1)).cast("double").alias(out))
    return densify(counts, "ts", by, 0, freq).drop("is_imputed")


def missing_periods(df: DataFrame, date: str = "date", by: Sequence[str] = ("series_id",), step: str = "day") -> DataFrame:
    """Steps without a row between the first and the last row of each series."""
    w = Window.partitionBy(*by).orderBy(date)
    gaps = df.select(*by, _shift(F.col(date), step, 1).alias("_lo"), _shift(F.lead(date).over(w), step, -1).alias("_hi"))
    gaps = gaps.where(F.col("_lo") <= F.col("_hi"))
    return gaps.select(*by, F.explode(_steps(F.col("_lo"), F.col("_hi"), step)).alias(date))


def future_dates(df: DataFrame, n: int, date: str = "date", by: Sequence[str] = ("series_id",)) -> DataFrame:
    """The n days after the last row of each series."""
    last = df.groupBy(*by).agg(F.max(date).alias("_last"))
    days = F.sequence(F.date_add("_last", 1), F.date_add("_last", n))
    return last.select(*by, F.explode(days).alias(date))


def future_features(dates: DataFrame, columns: Sequence[str], known: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    """Feature rows for future dates in training order: known columns, and zero for the others."""
    zero = F.lit(0.0)
    return dates.select(*keep, *[known[c].alias(c) if c in known else zero.alias(c) for c in columns])


def space_time_grid(
    hits: DataFrame,
    hour: str = "hour_bin",
    lat: str = "lat_id",
    lon: str = "lon_id",
    count: str = "ticket_count",
    max_rows: int | None = 50_000_000_000,
) -> DataFrame:
    """All hours times all latitudes times all longitudes seen, with counts and a 0/1 label.

    ``hits`` has one row per hour and cell. Only (hour, latitude) pairs are shuffled; the longitudes
    are written out afterwards within each row, so the full product never moves. Refuses a product
    above ``max_rows`` before it starts. Needs one small job to measure that product.
    """
    axes = hits.agg(
        F.min(hour).alias("lo"),
        F.max(hour).alias("hi"),
        F.sort_array(F.collect_set(lat)).alias("lats"),
        F.sort_array(F.collect_set(lon)).alias("lons"),
    )
    seconds = [F.unix_seconds(F.col(c).cast("timestamp")) for c in ("lo", "hi")]
    size = axes.select(
        "lo",
        F.floor((seconds[1] - seconds[0]) / 3600 + 1).alias("hours"),
        (F.size("lats") * F.size("lons")).alias("cells"),
    ).first()
    n_hours = size["hours"] or 0
    if max_rows is not None and n_hours * size["cells"] > max_rows:
        raise ValueError(f"grid of {n_hours * size['cells']} rows exceeds {max_rows}; use visited_grid")
    lats, lons = axes.select("lats").scalar(), axes.select("lons").scalar()
    first_hour = F.lit(size["lo"]).cast("timestamp_ntz")
    hours = hits.sparkSession.range(n_hours).select((first_hour + F.make_dt_interval(F.lit(0), F.col("id"))).alias(hour))
    strips = hours.select(hour, F.explode(lats).alias(lat))
    row_hits = hits.groupBy(hour, lat).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(lon), F.col(count)))).alias("_hits")
    )
    joined = strips.join(row_hits, [hour, lat], "left")
    cells = joined.select(hour, lat, "_hits", F.explode(lons).alias(lon))
    n = F.coalesce(F.try_element_at("_hits", F.col(lon)), F.lit(0)).cast("long")
    return cells.select(hour, lat, lon, n.alias(count), (n > 0).cast("int").alias("label"))


def visited_grid(
    events: DataFrame, date: str = "date", lat: str = "lat_id", lon: str = "lon_id", hour: str = "hour"
) -> DataFrame:
    """Each cell visited on a date times 24 hours, with the count and a 0/1 label.

    24 counters per cell and date in one aggregate, then written out; there is nothing to join.
    """
    counters = F.array(*[F.count_if(F.col(hour) == h) for h in range(24)])
    cells = events.groupBy(date, lat, lon).agg(counters.alias("_by_hour"))
    rows = spread(cells, date, lat, lon).select(date, lat, lon, F.posexplode("_by_hour").alias(hour, "ticket_count"))
    return rows.withColumn("label", (F.col("ticket_count") > 0).cast("int"))
