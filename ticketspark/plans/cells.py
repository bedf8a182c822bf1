"""Events to a ticket probability per cell and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import encode
from ..operators import aggregate, clean, densify, evaluate, levels, models, spatial, splits
from ..session import materialize

SAMPLE_KEY = ["date", "lat_id", "lon_id", "hour"]


def cell_events(raw: DataFrame, digits: int = 3, box=encode.CITY_BOX) -> DataFrame:
    """Clean, bounded events with their cell, hour, weekday, month and date; a narrow plan."""
    df = clean.resolve_event_time(clean.normalize_columns(raw), infer=True)
    df = clean.to_numeric(df, ["latitude", "longitude"])
    df = clean.drop_nulls(df, ["event_ts", "latitude", "longitude"])
    df = clean.bbox(df, box=box) if box else df
    ts = F.col("event_ts")
    return df.select(
        ts.alias("issue_datetime"),
        "latitude",
        "longitude",
        encode.grid_id(F.col("latitude"), digits).alias("lat_id"),
        encode.grid_id(F.col("longitude"), digits).alias("lon_id"),
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("day_of_week"),
        F.month(ts).alias("month"),
        F.to_date(ts).alias("date"),
    )


def samples(events: DataFrame, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """Hit cell-hours and as many empty ones (times ``ratio``) of cells visited that day, with a point each."""
    grid = densify.visited_grid(events).drop("ticket_count")
    drawn = splits.downsample_negatives(grid, SAMPLE_KEY, ratio=ratio, seed=seed)
    return spatial.representative_points(events, drawn)


def fit(events: DataFrame, ratio: float = 1.0, seed: int = 42, trees: bool = False) -> dict:
    """Model, cell table, coordinate ranges, usual month and scored test rows."""
    rows = materialize(splits.stratified_split(samples(events, ratio, seed), "label", SAMPLE_KEY, seed=seed), "cell-samples")
    cells = materialize(spatial.cell_ids(rows), "cells")
    ranges = models.coordinate_ranges(rows)
    encoded = models.geo_encode(rows, cells, ranges)
    model = models.train_geo(encoded.where("split = 'train'"), trees, seed)
    return {
        "model": model,
        "cells": cells,
        "ranges": ranges,
        "month_mode": aggregate.mode_value(rows, "month").scalar(),
        "test": models.score_geo(model, encoded.where("split = 'test'")),
    }


def report(fitted: dict) -> DataFrame:
    return evaluate.ranking_scores(fitted["test"])


def fit_weights(events: DataFrame, prior: float = 1.0) -> dict:
    """Weights of levels from every visited cell's 24 hours a day, with the cell table, coordinate ranges and usual month.

    Nothing is sampled: empty hours are rows of the counting, and only counts of levels are shuffled.
    ``events`` has date, hour, lat_id, lon_id, latitude and longitude.
    """
    hours = materialize(densify.visited_grid(events), "cell-hours")
    cells = materialize(spatial.cell_ids(events), "cells")
    parts = {"day_of_week": F.weekday("date"), "month": F.month("date"), "month_code": F.month("date") - 1}
    rows = spatial.attach_cell_id(hours, cells).withColumns(parts)
    counts = materialize(levels.level_counts(rows, models.GEO_CODES), "level-counts")
    return {
        "weights": levels.level_weights(counts, prior),
        "cells": cells,
        "ranges": models.coordinate_ranges(events),
        "month_mode": aggregate.mode_value(rows, "month").scalar(),
    }
