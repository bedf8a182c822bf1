"""Lenient parsing: a bad value becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ts(c: Column, formats: tuple[str, ...] = ()) -> Column:
    """Timestamp without zone; tries each format in turn, or the ISO forms when none is given."""
    if not formats:
        return c.try_cast("timestamp_ntz")
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


def strip_zone(c: Column) -> Column:
    """Drop the zone, keeping the wall clock of the session zone."""
    return c.cast("timestamp_ntz")


def hhmm(c: Column) -> tuple[Column, Column]:
    """Hour and minute of a clock integer such as 930; null when it is no valid time."""
    n = c.try_cast("int")
    hour = F.floor(n / 100).cast("int")
    minute = F.pmod(n, F.lit(100)).cast("int")
    valid = (n >= 0) & (hour < 24) & (minute < 60)
    return F.when(valid, hour), F.when(valid, minute)


def compose_datetime(day: Column, hour: Column, minute: Column) -> Column:
    """Midnight of ``day`` plus hours and minutes."""
    zero = F.lit(0)
    return F.date_trunc("day", day).cast("timestamp_ntz") + F.make_dt_interval(zero, hour, minute, F.lit(0).cast("decimal(18,6)"))


def to_number(c: Column, fill: float | None = None) -> Column:
    """Double, null (or ``fill``) when the text is no number."""
    n = c.try_cast("double")
    return n if fill is None else F.coalesce(n, F.lit(float(fill)))


def flag_to_int(c: Column) -> Column:
    """0/1 from booleans or text, 0 when unknown."""
    return F.coalesce(c.try_cast("boolean").cast("int"), F.lit(0))
