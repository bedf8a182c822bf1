"""Numeric encodings: grids, scaling, logs, flags, shares and codes."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: city bounding box in degrees
CITY_BOX = {"lat": (38.78, 39.03), "lon": (-77.12, -76.90)}


def grid_id(c: Column, digits: int = 3) -> Column:
    """Integer cell of a coordinate rounded half to even; the degree value is id / 10**digits."""
    return F.rint(c * float(10**digits)).cast("long")


def grid_floor_id(c: Column, cell: float = 0.001, exact_multiple: bool = False) -> Column:
    """Integer cell by floor division.

    ``exact_multiple`` takes the remainder first, which is how a floating ``//`` treats coordinates
    that sit on a cell edge.
    """
    if not exact_multiple:
        return F.floor(c / cell).cast("long")
    rem = c % F.lit(cell)
    rem = F.when(rem < 0, rem + cell).otherwise(rem)
    return F.floor((c - rem) / cell + 0.5).cast("long")


def in_box(lat: Column, lon: Column, box=CITY_BOX) -> Column:
    return lat.between(*box["lat"]) & lon.between(*box["lon"])


def minmax(c: Column, lo: Column | float, hi: Column | float) -> Column:
    """Scale [lo, hi] to [-1, 1]; a span under 1e-6 counts as 1e-6."""
    lo, hi = (x if isinstance(x, Column) else F.lit(float(x)) for x in (lo, hi))
    return (c - lo) / F.greatest(F.lit(1e-6), hi - lo) * 2.0 - 1.0


def standard(c: Column, mean: Column, std: Column) -> Column:
    """(c - mean) / std, a zero deviation counting as one and null as zero."""
    return F.coalesce((c - mean) / F.when(std == 0, F.lit(1.0)).otherwise(std), F.lit(0.0))


def finite(c: Column, fill: float = 0.0) -> Column:
    """``fill`` in place of null, NaN and both infinities."""
    d = c.cast("double")
    bad = d.isNull() | F.isnan(d) | (F.abs(d) == float("inf"))
    return F.when(bad, F.lit(fill)).otherwise(d)


def unlog(c: Column, cap: Column | float) -> Column:
    """expm1 with the exponent held at ``cap``."""
    return F.expm1(F.least(c, cap if isinstance(cap, Column) else F.lit(float(cap))))


def log_cap(max_count: Column) -> Column:
    """Largest exponent to undo: log1p of the largest training count, plus two."""
    return F.log1p(F.greatest(F.lit(1.0), max_count.cast("double"))) + 2.0


def zero_based(name: str, c: Column) -> Column:
    """Month, day of month and week as codes from 0; weeks stay within 0..52."""
    if name in ("month", "day_of_month"):
        return c - 1
    if name == "week_of_year":
        return F.least(F.greatest(c - 1, F.lit(0)), F.lit(52))
    return c


def hit_label(count: Column) -> Column:
    return (count > 0).cast("int")


def one_hot(c: Column, values: list, prefix: str, drop_first: bool = True) -> dict[str, Column]:
    """0/1 column per value in sorted order; the first value is the base level and gets none."""
    kept = sorted(values)[1:] if drop_first else sorted(values)
    return {f"{prefix}_{v}": F.coalesce((c == v).cast("int"), F.lit(0)) for v in kept}


def row_sum(cols: list[str]) -> Column:
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def shares(cols: list[str]) -> dict[str, Column]:
    """Part of the row total in each column; a row without total gets zeros."""
    total = row_sum(cols)
    return {f"{c}_share": F.when(total == 0, 0.0).otherwise(F.coalesce(F.col(c), F.lit(0)) / total) for c in cols}


def pct_gain(base: Column, new: Column) -> Column:
    """Gain of ``new`` over ``base`` in percent, null when the base is not positive."""
    return F.when(base > 0, (base - new) / base * 100.0)


def report_round(c: Column, digits: int = 2) -> Column:
    """Scale, round half to even and scale back."""
    return F.rint(c * float(10**digits)) / float(10**digits)
