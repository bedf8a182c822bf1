"""Grid cells: ids, weights, allocation and snapping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import attach
from .ordering import exact_quantiles, group_medians

CELL = ("lat_id", "lon_id")

# broadcast bound for bucket tables: rows of two or four integers, a few megabytes
BROADCAST_CELLS = 100_000


def cell_ids(events: DataFrame, lat: str = "lat_id", lon: str = "lon_id", out: str = "grid_id") -> DataFrame:
    """Dense ids from 0 over the distinct cells, in latitude and longitude order.

    Numbered within each latitude; latitudes start where the cells of those before them end. The
    window without keys sees one row per latitude.
    """
    cells = events.select(lat, lon).distinct()
    per_lat = cells.groupBy(lat).agg(F.count(F.lit(1)).alias("_n"))
    starts = per_lat.select(lat, (F.sum("_n").over(Window.partitionBy(F.lit(1)).orderBy(lat)) - F.col("_n")).alias("_start"))
    within = cells.withColumn("_i", F.row_number().over(Window.partitionBy(lat).orderBy(lon)) - 1)
    return within.join(starts, lat).select(lat, lon, (F.col("_start") + F.col("_i")).alias(out))


def attach_cell_id(df: DataFrame, cells: DataFrame, on: Sequence[str] = CELL) -> DataFrame:
    """Cell id by exact cell, null where the cell is unknown."""
    return attach(df, cells, list(on))


def spatial_weights(events: DataFrame, group: Sequence[str] = ("day_of_week", "month"), cell: Sequence[str] = CELL) -> DataFrame:
    """Part of each cell in the events of its weekday and month.

    A weekday and month make 84 groups at most, so the totals are broadcast.
    """
    counts = events.groupBy(*group, *cell).agg(F.count(F.lit(1)).alias("_n"))
    sums = counts.groupBy(*group).agg(F.sum("_n").alias("_total"))
    joined = counts.join(F.broadcast(sums), list(group))
    return joined.select(*group, *cell, (F.col("_n") / F.col("_total")).alias("weight"))


def allocate(
    forecast: DataFrame, weights: DataFrame, date: str = "date", total: str = "y_pred", cell: Sequence[str] = CELL
) -> DataFrame:
    """Spread each day's forecast over the cells by weight.

    A day whose weekday and month have no weights uses the mean weight per cell. A negative or
    missing total counts as zero. One equi-join: the mean weights are stored under the key (-1, -1).
    """
    group = ["day_of_week", "month"]
    seen = weights.select(*group).distinct().withColumn("_seen", F.lit(True))
    means = weights.groupBy(*cell).agg(F.avg("weight").alias("weight"))
    rest = means.select(F.lit(-1).alias("day_of_week"), F.lit(-1).alias("month"), *cell, "weight")
    table = weights.select(F.col("day_of_week").cast("int"), F.col("month").cast("int"), *cell, "weight").unionByName(rest)
    days = forecast.select(
        date,
        F.greatest(F.lit(0.0), F.coalesce(F.col(total).cast("double"), F.lit(0.0))).alias("_total"),
        F.weekday(date).alias("day_of_week"),
        F.month(date).alias("month"),
    )
    # 84 rows at most
    days = days.join(F.broadcast(seen), group, "left")
    known = F.col("_seen").isNotNull()
    days = days.select(
        date,
        "_total",
        F.when(known, F.col("day_of_week")).otherwise(-1).alias("day_of_week"),
        F.when(known, F.col("month")).otherwise(-1).alias("month"),
    )
    return days.join(table, group).select(date, *cell, (F.col("weight") * F.col("_total")).alias("allocated"))


def representative_points(
    events: DataFrame, samples: DataFrame, keys: Sequence[str] = ("date", "lat_id", "lon_id", "hour"), scale: int = 1000
) -> DataFrame:
    """Median coordinates of each sampled cell and hour, or the cell's own when it has no event.

    Weekday and month follow from the date, which is part of the key.
    """
    points = group_medians(events, keys, ["latitude", "longitude"])
    return samples.join(points, list(keys), "left").withColumns(
        {
            "latitude": F.coalesce("latitude", F.col("lat_id") / float(scale)),
            "longitude": F.coalesce("longitude", F.col("lon_id") / float(scale)),
            "day_of_week": F.weekday("date"),
            "month": F.month("date"),
        }
    )


def dist_center(df: DataFrame, lat: str = "latitude", lon: str = "longitude", out: str = "dist_center") -> DataFrame:
    """Distance to the point of the median latitude and the median longitude."""
    mid = [exact_quantiles(df, c, {"m": 0.5}).scalar() for c in (lat, lon)]
    return df.withColumn(out, F.hypot(F.col(lat) - mid[0], F.col(lon) - mid[1]))


def nearest_cells(points: DataFrame, cells: DataFrame, fan: int = 8, id_col: str = "grid_id") -> DataFrame:
    """Nearest known cell of each distinct point in whole cell units, the smallest id on a tie.

    Descends from one bucket that covers all cells to single cells. A bucket stays a candidate while
    its nearest corner is no further than the far corner of the best one, so few remain per point
    and the result is exact. No point is paired with all cells. Writes the cell table once and brings
    four bounds to the driver.
    """
    lat, lon = CELL
    # every level reads the cell table
    cells = materialize(cells.select(lat, lon, id_col), "cells")
    ends = cells.agg(F.min(lat), F.max(lat), F.min(lon), F.max(lon)).first()
    if ends[0] is None:
        return points.select(lat, lon).distinct().withColumn(id_col, F.lit(None).cast("long"))
    span = max(ends[1] - ends[0], ends[3] - ends[2]) + 1
    depth = 0
    while fan**depth < span:
        depth += 1

    def bucket(c: str, lo: int, level: int):
        return F.floor((F.col(c) - lo) / F.lit(fan**level)).cast("long")

    front = points.select(lat, lon).distinct().withColumns({"_b_lat": F.lit(0).cast("long"), "_b_lon": F.lit(0).cast("long")})
    w = Window.partitionBy(lat, lon)
    for level in range(depth - 1, -1, -1):
        size = fan**level
        ids = [F.col(id_col)] if level == 0 else []
        table = cells.select(bucket(lat, ends[0], level).alias("_c_lat"), bucket(lon, ends[2], level).alias("_c_lon"), *ids)
        table = table if level == 0 else table.distinct()
        table = table.withColumns({"_b_lat": F.floor(F.col("_c_lat") / fan), "_b_lon": F.floor(F.col("_c_lon") / fan)})
        buckets = (-(-span // size)) ** 2
        table = F.broadcast(table) if buckets <= BROADCAST_CELLS else table
        kids = front.join(table, ["_b_lat", "_b_lon"])

        def gap(c: str, b: str, lo: int, far: bool):
            first = F.col(b) * size + lo
            last = first + (size - 1)
            if far:
                return F.greatest(F.abs(F.col(c) - first), F.abs(F.col(c) - last))
            return F.greatest(first - F.col(c), F.col(c) - last, F.lit(0))

        near = gap(lat, "_c_lat", ends[0], False), gap(lon, "_c_lon", ends[2], False)
        far = gap(lat, "_c_lat", ends[0], True), gap(lon, "_c_lon", ends[2], True)
        kids = kids.withColumns({"_near": near[0] * near[0] + near[1] * near[1], "_far": far[0] * far[0] + far[1] * far[1]})
        if level == 0:
            return kids.groupBy(lat, lon).agg(F.min_by(id_col, F.struct("_near", id_col)).alias(id_col))
        kept = kids.withColumn("_best", F.min("_far").over(w)).where(F.col("_near") <= F.col("_best"))
        front = kept.select(lat, lon, F.col("_c_lat").alias("_b_lat"), F.col("_c_lon").alias("_b_lon"))
    only = cells.agg(F.min(id_col)).scalar()
    return front.select(lat, lon, only.alias(id_col))


def snap_to_cell(points: DataFrame, cells: DataFrame, id_col: str = "grid_id") -> DataFrame:
    """Cell id of every point: its own cell when known, else the nearest known cell.

    Works on distinct cells, so a crowded cell is looked up once.
    """
    lat, lon = CELL
    places = points.select(lat, lon).distinct()
    exact = places.join(cells.select(lat, lon, id_col), [lat, lon], "left")
    found = exact.where(F.col(id_col).isNotNull())
    snapped = nearest_cells(exact.where(F.col(id_col).isNull()), cells, id_col=id_col)
    lookup = found.withColumn("snapped", F.lit(False)).unionByName(snapped.withColumn("snapped", F.lit(True)))
    return attach(points, lookup, [lat, lon])
