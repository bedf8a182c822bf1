"""Calendar parts, seasonal terms and holidays as plain column expressions."""

from __future__ import annotations

from functools import reduce
from math import pi
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: weekday names, Monday first
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# fixed values: holidays on a set day, as (month, day, first year)
SET_DAY_HOLIDAYS = [(1, 1, 1), (6, 19, 2021), (7, 4, 1), (11, 11, 1), (12, 25, 1)]

# fixed values: holidays on a weekday, as (month, weekday Monday=0, first day, last day)
FLOATING_HOLIDAYS = [
    (1, 0, 15, 21),
    (2, 0, 15, 21),
    (5, 0, 25, 31),
    (9, 0, 1, 7),
    (10, 0, 8, 14),
    (11, 3, 22, 28),
]

# fixed values: blossom season, first and last (month, day)
SEASON_START = (3, 15)
SEASON_END = (4, 20)

YEAR_DAYS = 365.25


def weekday(c: Column) -> Column:
    """Monday = 0."""
    return F.weekday(c)


def weekday_name(c: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAYS]), F.weekday(c) + 1)


def is_weekend(c: Column) -> Column:
    return F.weekday(c) >= 5


def with_calendar(df: DataFrame, source: str = "date", hour: bool = False) -> DataFrame:
    """Year, month, day, weekday number and name, ISO week, day of year and the weekend flag."""
    c = F.col(source)
    parts = {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "day_of_week": F.weekday(c),
        "day_name": weekday_name(c),
        "week_of_year": F.weekofyear(c),
        "day_of_year": F.dayofyear(c),
        "is_weekend": is_weekend(c),
    }
    if hour:
        parts["hour"] = F.hour(c)
    return df.withColumns(parts)


def hour_floor(c: Column) -> Column:
    return F.date_trunc("hour", c)


def week_start(c: Column) -> Column:
    """Monday of the week, as a date."""
    day = F.to_date(c)
    return F.date_sub(day, F.weekday(day))


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def fourier_terms(source: str, orders=(1, 2), period: float = YEAR_DAYS) -> dict[str, Column]:
    """sin_k and cos_k of the day of the year."""
    doy = F.dayofyear(F.col(source)).cast("double")
    terms = {}
    for k in orders:
        angle = doy * (2 * pi * k) / period
        terms[f"sin_{k}"] = F.sin(angle)
        terms[f"cos_{k}"] = F.cos(angle)
    return terms


def cycle(c: Column, period: float, offset: int = 0) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle of ``period`` steps."""
    angle = (c.cast("double") - offset) * (2 * pi) / period
    return F.sin(angle), F.cos(angle)


def cyclical_terms(hour: Column | None = None, dow: Column | None = None, month: Column | None = None) -> dict[str, Column]:
    """Hour of 24, weekday of 7 and month of 12 as sine and cosine pairs."""
    out: dict[str, Column] = {}
    for name, c, period, offset in (("hour", hour, 24, 0), ("dow", dow, 7, 0), ("month", month, 12, 1)):
        if c is not None:
            out[f"{name}_sin"], out[f"{name}_cos"] = cycle(c, period, offset)
    return out


def in_season(c: Column, start=SEASON_START, end=SEASON_END) -> Column:
    """True from ``start`` to ``end`` of each year, both days included."""
    day = F.to_date(c)
    first = F.make_date(F.year(day), F.lit(start[0]), F.lit(start[1]))
    last = F.make_date(F.year(day), F.lit(end[0]), F.lit(end[1]))
    return day.between(first, last)


def is_month_end(c: Column) -> Column:
    return F.last_day(c) == F.to_date(c)


def _on_set_day(d: Column) -> Column:
    tests = [
        (F.month(d) == month) & (F.dayofmonth(d) == day) & (F.year(d) >= first_year)
        for month, day, first_year in SET_DAY_HOLIDAYS
    ]
    return reduce(or_, tests)


def is_holiday(c: Column) -> Column:
    """Federal holiday test by rule, with Saturday and Sunday holidays also kept on Friday and Monday.

    A pure expression: it needs no holiday table, so no join, at any data size.
    """
    d = F.to_date(c)
    floating = [
        (F.month(d) == month) & (F.weekday(d) == dow) & F.dayofmonth(d).between(first, last)
        for month, dow, first, last in FLOATING_HOLIDAYS
    ]
    observed = ((F.weekday(d) == 4) & _on_set_day(F.date_add(d, 1))) | (
        (F.weekday(d) == 0) & _on_set_day(F.date_sub(d, 1))
    )
    return reduce(or_, floating) | _on_set_day(d) | observed


def is_holiday_week(week: Column) -> Column:
    """True when any of the seven days from ``week`` on is a holiday."""
    days = F.sequence(F.to_date(week), F.date_add(F.to_date(week), 6))
    return F.exists(days, is_holiday)


def target_date(c: Column, horizon: Column | int) -> Column:
    """Day the forecast made on ``c`` is for."""
    return F.date_add(F.to_date(c), horizon)


def horizon_label(h: Column) -> Column:
    return F.concat(F.lit("t+"), h.cast("string"))
