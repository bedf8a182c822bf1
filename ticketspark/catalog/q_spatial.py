"""Cell lookup, snapping and allocation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import spatial
from . import fixtures as fx
from .registry import query, r6, s6

_KNOWN = """known AS (SELECT DISTINCT lat_id, lon_id FROM cell_events WHERE event_type = 'purchase' AND lat_id % 3 = 0),
cells AS (SELECT lat_id, lon_id, row_number() OVER (ORDER BY lat_id, lon_id) - 1 AS grid_id FROM known)"""


def _known(spark, d):
    e = fx.cell_events(spark, d)
    return spatial.cell_ids(e.where("event_type = 'purchase' AND lat_id % 3 = 0"))


@query(
    "e5_cell_id_lookup",
    f"WITH {fx.CELLS}, {_KNOWN} SELECT event_id, e.lat_id, e.lon_id, grid_id FROM cell_events e LEFT JOIN cells c ON e.lat_id = c.lat_id AND e.lon_id = c.lon_id",
)
def lookup(spark, d):
    e = fx.cell_events(spark, d).select("event_id", "lat_id", "lon_id")
    return spatial.attach_cell_id(e, _known(spark, d))


@query(
    "e6_nearest_cell_snap",
    f"""WITH {fx.CELLS}, {_KNOWN}, p AS (SELECT DISTINCT lat_id, lon_id FROM cell_events),
n AS (SELECT p.lat_id, p.lon_id, arg_min(c.grid_id, power(p.lat_id - c.lat_id, 2) + power(p.lon_id - c.lon_id, 2) + c.grid_id * 1e-9) AS grid_id
  FROM p, cells c GROUP BY 1, 2)
SELECT e.event_id, e.lat_id, e.lon_id, n.grid_id, c.grid_id IS NULL AS snapped FROM cell_events e JOIN n ON e.lat_id = n.lat_id AND e.lon_id = n.lon_id
LEFT JOIN cells c ON e.lat_id = c.lat_id AND e.lon_id = c.lon_id""",
)
def snap(spark, d):
    e = fx.cell_events(spark, d).select("event_id", "lat_id", "lon_id")
    return spatial.snap_to_cell(e, _known(spark, d))


@query(
    "e12_spatial_allocation",
    f"""WITH {fx.CELLS}, c AS (SELECT day_of_week, month, lat_id, lon_id, count(*) AS n FROM cell_events WHERE day_of_week < 6 GROUP BY 1, 2, 3, 4),
w AS (SELECT day_of_week, month, lat_id, lon_id, n / sum(n) OVER (PARTITION BY day_of_week, month) AS weight FROM c),
m AS (SELECT lat_id, lon_id, avg(weight) AS weight FROM w GROUP BY 1, 2),
f AS (SELECT date, count(*) - 12.0 AS total FROM cell_events GROUP BY date),
k AS (SELECT date, greatest(total, 0) AS total, isodow(date) - 1 AS dow, month(date) AS mon FROM f)
SELECT date, lat_id, lon_id, {s6("weight * total", "allocated")} FROM k JOIN w ON k.dow = w.day_of_week AND k.mon = w.month
UNION ALL SELECT date, lat_id, lon_id, {s6("weight * total", "allocated")} FROM k, m WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.day_of_week = k.dow AND w.month = k.mon)""",
)
def allocation(spark, d):
    """No event of a Sunday enters the weights, so Sundays fall back to the mean weights."""
    e = fx.cell_events(spark, d)
    weights = spatial.spatial_weights(e.where("day_of_week < 6"))
    forecast = e.groupBy("date").agg((F.count(F.lit(1)) - 12.0).alias("y_pred"))
    x = spatial.allocate(forecast, weights)
    return x.select("date", "lat_id", "lon_id", r6("allocated", "allocated"))
