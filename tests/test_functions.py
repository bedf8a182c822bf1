import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.frames import column, days, rows
from ticketspark.functions import calendar, encode, hashing, metrics, parse
from ticketspark.operators import aggregate, clean, profile


def _dates(spark, values):
    return spark.createDataFrame([(d,) for d in values], "date date")


def test_calendar_matches_pandas_over_year_ends_and_leap_days(spark):
    span = days(25, dt.date(2020, 12, 20)) + days(5, dt.date(2024, 2, 26))
    got = calendar.with_calendar(_dates(spark, span)).orderBy("date").toPandas()
    p = pd.to_datetime(pd.Series(sorted(span)))
    assert got.day_of_week.tolist() == p.dt.dayofweek.tolist()
    assert got.day_name.tolist() == p.dt.day_name().tolist()
    assert got.week_of_year.tolist() == p.dt.isocalendar().week.tolist()
    assert got.day_of_year.tolist() == p.dt.dayofyear.tolist()
    assert got.is_weekend.tolist() == (p.dt.dayofweek >= 5).tolist()


def test_week_starts_on_monday(spark):
    got = _dates(spark, days(14, dt.date(2020, 12, 28))).withColumn("w", calendar.week_start(F.col("date")))
    p = pd.to_datetime(pd.Series(days(14, dt.date(2020, 12, 28)))).dt.to_period("W").dt.start_time.dt.date
    assert column(got, "w", "date") == p.tolist()


def test_holidays(spark):
    known = {
        dt.date(2024, 1, 1), dt.date(2024, 1, 15), dt.date(2024, 2, 19), dt.date(2024, 5, 27), dt.date(2024, 6, 19),
        dt.date(2024, 7, 4), dt.date(2024, 9, 2), dt.date(2024, 10, 14), dt.date(2024, 11, 11), dt.date(2024, 11, 28), dt.date(2024, 12, 25),
    }
    df = _dates(spark, days(366, dt.date(2024, 1, 1))).where(calendar.is_holiday(F.col("date")))
    assert set(column(df, "date", "date")) == known


@pytest.mark.parametrize(
    "day,expected",
    [
        (dt.date(2020, 7, 3), True),  # the 4th is a Saturday
        (dt.date(2021, 7, 5), True),  # the 4th is a Sunday
        (dt.date(2021, 12, 31), True),  # New Year's Day is a Saturday
        (dt.date(2020, 6, 19), False),  # not yet a holiday
        (dt.date(2021, 6, 18), True),  # the 19th is a Saturday
        (dt.date(2020, 7, 6), False),
    ],
)
def test_observed_holidays(spark, day, expected):
    assert _dates(spark, [day]).select(calendar.is_holiday(F.col("date"))).first()[0] is expected


def test_season_and_month_end(spark):
    span = [dt.date(2024, 3, 14), dt.date(2024, 3, 15), dt.date(2024, 4, 20), dt.date(2024, 4, 21), dt.date(2024, 2, 29)]
    df = _dates(spark, span).select("date", calendar.in_season(F.col("date")).alias("s"), calendar.is_month_end(F.col("date")).alias("e"))
    assert {r["date"]: (r["s"], r["e"]) for r in df.collect()} == {
        span[0]: (False, False), span[1]: (True, False), span[2]: (True, False), span[3]: (False, False), span[4]: (False, True),
    }


def test_hhmm(spark):
    df = spark.createDataFrame([(v,) for v in (0, 30, 930, 2359, 2400, 2560, 1275, -5, None)], "t int")
    h, m = parse.hhmm(F.col("t"))
    assert rows(df.select(h, m)) == [(0, 0), (0, 30), (9, 30), (23, 59), (None, None), (None, None), (None, None), (None, None), (None, None)]


def test_lenient_parsing(spark):
    df = spark.createDataFrame([("2024-03-01 10:30:00",), ("2024-03-01",), ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(parse.parse_ts(F.col("s"))).collect()]
    assert got == [dt.datetime(2024, 3, 1, 10, 30), dt.datetime(2024, 3, 1), None, None]
    nums = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "s string")
    assert [r[0] for r in nums.select(parse.to_number(F.col("s"), 0)).collect()] == [1.5, 0.0, 0.0]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(-80_000_000, 80_000_000), min_size=50, max_size=200))
def test_grid_rounding_matches_pandas(spark, micro):
    x = pd.Series([m / 1e6 for m in micro])
    got = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double").select("i", encode.grid_id(F.col("x")).alias("g"))
    assert column(got, "g", "i") == [round(v * 1000) for v in x.round(3)]


def test_finite_and_minmax(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, float("-inf")), (3, float("nan")), (4, None), (5, 2.5)], "i int, x double")
    assert column(df.withColumn("x", encode.finite(F.col("x"))), "x", "i") == [0, 0, 0, 0, 2.5]
    flat = spark.createDataFrame([(5.0,)], "x double").select(encode.minmax(F.col("x"), 5.0, 5.0))
    assert flat.first()[0] == -1.0


def test_shares_sum_to_one_or_zero(spark):
    df = spark.createDataFrame([(1, 2, 3), (0, 0, 0), (None, 1, 0)], "a int, b int, c int")
    out = df.select(*[c.alias(n) for n, c in encode.shares(["a", "b", "c"]).items()])
    assert [round(sum(r), 9) for r in out.collect()] == [1.0, 0.0, 1.0]


def test_codes_of_unseen_values(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "v string")
    test = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "v string")
    got = aggregate.apply_codes(test, aggregate.fit_codes(train, "v"), "v", "code")
    assert {r["v"]: r["code"] for r in got.collect()} == {"a": 0, "b": 1, "z": -1, None: -1}


def test_error_measures_match_numpy(spark):
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 9, 60).astype(float), rng.random(60) * 9
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y_true double, y_pred double")
    e = np.abs(y - p)
    want = {
        "mae": e.mean(),
        "rmse": math.sqrt((e**2).mean()),
        "floor1": (e / np.maximum(y, 1)).mean() * 100,
        "skip_zero": (e[y > 0] / y[y > 0]).mean() * 100,
        "abs_eps": (e / (y + 1e-8)).mean() * 100,
        "sum": (200 * e / (y + p + 1e-8)).mean(),
        "half": (e / np.maximum((y + p) / 2, 1e-8)).mean() * 100,
        "wape": e.sum() / (y.sum() + 1e-8) * 100,
        "r2": 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(),
    }
    got = df.agg(
        metrics.mae("y_true", "y_pred").alias("mae"),
        metrics.rmse("y_true", "y_pred").alias("rmse"),
        *[metrics.mape("y_true", "y_pred", k).alias(k) for k in ("floor1", "skip_zero", "abs_eps")],
        *[metrics.smape("y_true", "y_pred", k).alias(k) for k in ("sum", "half")],
        metrics.wape("y_true", "y_pred").alias("wape"),
        metrics.r2("y_true", "y_pred").alias("r2"),
    ).first()
    for name, value in want.items():
        assert got[name] == pytest.approx(value, rel=1e-9), name


def test_mape_kind_must_be_known(spark):
    with pytest.raises(ValueError):
        metrics.mape("y_true", "y_pred", "plain")


def test_hash_is_stable_and_even(spark):
    df = spark.range(20000).select(hashing.key_hash(F.col("id")).alias("h"))
    buckets = df.select(hashing.hash_bucket(F.col("h"), 3).alias("b")).groupBy("b").count().collect()
    assert len(buckets) == 8 and all(2200 < r["count"] < 2800 for r in buckets)
    draws = spark.range(20000).select(F.pmod(hashing.mix(F.col("id"), F.lit(7)), F.lit(10)).alias("d")).groupBy("d").count().collect()
    assert len(draws) == 10 and all(1800 < r["count"] < 2200 for r in draws)


def test_header_and_time_resolution(spark):
    df = clean.normalize_columns(spark.createDataFrame([("2024-01-02", 1)], "` Issue_Date ` string, `N` int"))
    assert df.columns == ["issue_date", "n"]
    assert clean.resolve_event_time(df).first()["event_ts"] == dt.datetime(2024, 1, 2)
    parts = spark.createDataFrame([(2024, 2, 9), (2024, 13, 1)], "year int, month int, day int")
    assert [r["event_ts"] for r in clean.resolve_event_time(parts).collect()] == [dt.datetime(2024, 2, 9), None]
    with pytest.raises(ValueError):
        clean.resolve_event_time(df.drop("issue_date"))
    named = spark.createDataFrame([("2024-01-02",)], "`my date` string")
    assert clean.resolve_event_time(named, infer=True).first()["event_ts"] == dt.datetime(2024, 1, 2)


def test_profile_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", None)], "k string, v int")
    assert {r["column"]: (r["non_null"], r["nulls"]) for r in profile.profile_nulls(df).collect()} == {"k": (3, 1), "v": (3, 1)}
    assert profile.duplicate_count(df).first()[0] == 1
    assert profile.duplicate_count(df.limit(0)).first()[0] == 0
    approx = {r["column"]: r["distinct_values"] for r in profile.profile(df, approx=True).collect()}
    assert approx == {"k": 2, "v": 2}


def test_top_location_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "loc string")
    assert column(clean.top_location(df, "loc"), "loc", "loc") == ["a", "a"]
