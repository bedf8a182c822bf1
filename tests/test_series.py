import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.frames import column, days, rows, series
from ticketspark.operators import aggregate, densify, joins, reshape, splits, windows

EMPTY = "series_id string, date date, y double"


def test_gap_fill_covers_every_day_once_and_is_idempotent(spark):
    given = [dt.date(2024, 2, 27), dt.date(2024, 3, 2), dt.date(2024, 3, 3)]
    df = spark.createDataFrame([("a", given[0], 5.0), ("a", given[1], None), ("a", given[2], 2.0), ("b", given[1], 1.0)], EMPTY)
    out = densify.densify(df)
    a = out.where("series_id = 'a'")
    assert column(a, "date", "date") == days(6, given[0])
    assert column(a, "y", "date") == [5, 0, 0, 0, 0, 2]
    assert column(a, "is_imputed", "date") == [False, True, True, True, False, False]
    assert out.where("series_id = 'b'").count() == 1
    again = densify.densify(out.drop("is_imputed"))
    assert again.where("is_imputed").count() == 0 and again.count() == out.count()


def test_gap_fill_of_nothing_and_of_one_day(spark):
    assert densify.densify(spark.createDataFrame([], EMPTY)).count() == 0
    assert rows(densify.densify(series(spark, [3]))) == [("a", dt.date(2024, 1, 1), 3.0, False)]


def test_common_span(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("b", dt.date(2024, 1, 4), 2.0)], EMPTY)
    out = densify.densify(df, span="all")
    assert out.groupBy("series_id").count().orderBy("series_id").collect()[0]["count"] == 4
    assert out.where("y > 0").count() == 2 and out.count() == 8


def test_missing_periods(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("a", dt.date(2024, 1, 4))], "series_id string, date date")
    assert column(densify.missing_periods(df), "date", "date") == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    weeks = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("a", dt.date(2024, 1, 22))], "series_id string, date date")
    assert column(densify.missing_periods(weeks, step="week"), "date", "date") == [dt.date(2024, 1, 8), dt.date(2024, 1, 15)]


def test_hourly_resample(spark):
    ts = [dt.datetime(2024, 1, 1, 0, 5), dt.datetime(2024, 1, 1, 0, 50), dt.datetime(2024, 1, 1, 3, 0)]
    df = spark.createDataFrame([("a", t) for t in ts], "series_id string, ts timestamp_ntz")
    assert column(densify.resample_counts(df, "ts", "hour"), "y", "ts") == [2, 0, 0, 1]


@pytest.mark.parametrize("n", [29, 30, 31])
def test_rolling_matches_pandas_at_the_window_edge(spark, n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 20, n).astype(float)
    out = windows.add_rolling(series(spark, values), "y").orderBy("date").toPandas()
    p = pd.Series(values)
    for w, s in windows.DAILY_ROLLING:
        want = getattr(p.rolling(w), s)()
        np.testing.assert_allclose(out[f"y_roll{w}_{s}"].astype(float), want, rtol=1e-9, atol=1e-9)


def test_shifted_and_partial_rolling_match_pandas(spark):
    values = [3.0, None, 5.0, 1.0, 0.0, 8.0, 2.0, 2.0, 7.0]
    p = pd.Series(values)
    df = series(spark, values)
    safe = windows.add_rolling(df, "y", [(3, "mean"), (3, "std")], offset=1).orderBy("date").toPandas()
    np.testing.assert_allclose(safe.y_roll3_mean.astype(float), p.shift(1).rolling(3).mean())
    np.testing.assert_allclose(safe.y_roll3_std.astype(float), p.shift(1).rolling(3).std())
    part = windows.add_rolling(df, "y", [(4, "mean")], min_periods=2).orderBy("date").toPandas()
    np.testing.assert_allclose(part.y_roll4_mean.astype(float), p.rolling(4, min_periods=2).mean())


def test_features_do_not_see_the_future(spark):
    rng = np.random.default_rng(1)
    values = list(rng.integers(0, 20, 60).astype(float))
    changed = values[:40] + [v + 100 for v in values[40:]]

    def upto(vals):
        df = windows.add_lags(series(spark, vals), "y")
        df = windows.add_rolling(df, "y")
        df = windows.add_rolling(df, "y", [(7, "mean")], offset=1, name="safe")
        return rows(windows.difference(df, "y").where(F.col("date") < dt.date(2024, 2, 10)).drop("y"), "date")

    assert upto(values) == upto(changed)


def test_targets_stay_within_their_split(spark):
    df = series(spark, [1, 2, 3, 4, 5]).withColumn("split", F.when(F.col("date") < dt.date(2024, 1, 4), "train").otherwise("test"))
    out = windows.target_mask(df, "y", [1, 3])
    assert column(out, "label_1", "date") == [2, 3, 0, 5, 0]
    assert column(out, "mask_1", "date") == [1, 1, 0, 1, 0]
    assert column(out, "mask_3", "date") == [0, 0, 0, 0, 0]


@pytest.mark.parametrize("n,expected", [(36, 0), (37, 1), (40, 4)])
def test_sequences(spark, n, expected):
    out = windows.sequences(series(spark, range(n)), "y")
    assert out.count() == expected
    if expected:
        first = out.orderBy("date").first()
        assert first["history"] == [float(i) for i in range(30)]
        assert first["targets"] == [30.0, 32.0, 36.0]
        assert first["label_date"] == dt.date(2024, 1, 1) + dt.timedelta(days=36)


def test_lags_do_not_cross_series(spark):
    df = series(spark, [1, 2]).unionByName(series(spark, [8, 9], name="b"))
    assert column(windows.add_lags(df, "y", [1]), "y_lag_1", "series_id", "date") == [None, 1.0, None, 8.0]


def test_top_k_other(spark):
    df = spark.createDataFrame([(v,) for v in ["x", "x", "y", "z", None, None]], "v string")
    got = aggregate.top_k_other(df, "v", 2, "g")
    assert sorted(column(got, "g", "g")) == ["OTHER", "OTHER", "UNKNOWN", "UNKNOWN", "x", "x"]
    numbers = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    assert sorted(column(aggregate.top_k_other(numbers, "v", 1, "g"), "g", "g")) == ["1", "1", "OTHER"]


def test_scaler_of_a_constant_column(spark):
    df = spark.createDataFrame([(4.0, 1.0), (4.0, 3.0)], "c double, d double")
    got = {r["column"]: (r["mean"], r["std"]) for r in aggregate.fit_scaler(df, ["c", "d"], 0).collect()}
    assert got == {"c": (4.0, 1.0), "d": (2.0, 1.0)}


def test_future_dates(spark):
    assert column(densify.future_dates(series(spark, [1, 2]), 3), "date", "date") == days(3, dt.date(2024, 1, 3))


def test_grid_limit_and_shape(spark):
    hits = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0), 1, 5, 2), (dt.datetime(2024, 1, 1, 2), 3, 6, 1)], "hour_bin timestamp_ntz, lat_id long, lon_id long, ticket_count long")
    out = densify.space_time_grid(hits)
    assert out.count() == 3 * 2 * 2
    assert out.agg(F.sum("ticket_count"), F.sum("label")).first() == (3, 2)
    with pytest.raises(ValueError):
        densify.space_time_grid(hits, max_rows=11)


def test_visited_grid(spark):
    e = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 5, 7), (dt.date(2024, 1, 1), 1, 5, 7), (dt.date(2024, 1, 2), 2, 5, 0)], "date date, lat_id long, lon_id long, hour int")
    out = densify.visited_grid(e)
    assert out.count() == 48
    assert rows(out.where("label = 1").select("lat_id", "hour", "ticket_count"), "lat_id") == [(1, 7, 2), (2, 0, 1)]


def test_salted_join_keeps_all_rows_of_a_hot_key(spark):
    big = spark.range(1000).select("id", F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 5).alias("k"))
    stats = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for out in (joins.salted_join(big, stats, ["k"]), joins.attach(big, stats, ["k"])):
        assert out.count() == 1000 and out.where("n is null").count() == 0
        assert out.select("id").distinct().count() == 1000
    none = joins.salted_join(big, stats.where("k <> 1"), ["k"])
    assert none.count() == 1000 and none.where("n is null").count() == big.where("k = 1").count()


def test_attach_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    big = spark.range(100).select("id", (F.col("id") % 3).alias("k"))
    out = joins.attach(big, big.groupBy("k").agg(F.max("id").alias("m")), ["k"])
    assert out.count() == 100 and out.agg(F.sum("m")).first()[0] == 34 * 99 + 33 * 97 + 33 * 98


def test_pivot_round_trip(spark):
    long = spark.createDataFrame(
        [(dt.date(2024, 1, 1), m, h, 1.0 * h) for m in ("A", "B") for h in (1, 3)], "date date, model string, horizon int, y_pred double"
    )
    wide = long.groupBy("date").agg(*[F.max(F.when((F.col("model") == m) & (F.col("horizon") == h), F.col("y_pred"))).alias(f"{m} t+{h}") for m in ("A", "B") for h in (1, 3)])
    assert rows(reshape.tidy_predictions(wide), "model", "horizon") == rows(long, "model", "horizon")


def test_fraction_split_covers_and_keeps_order(spark):
    out = splits.fraction_split(series(spark, range(10)))
    assert column(out, "split", "date") == ["train"] * 6 + ["val"] + ["test"] * 3
    assert column(splits.fraction_split(series(spark, [1, 2])), "split", "date") == ["val", "test"]
    assert splits.fraction_split(spark.createDataFrame([], EMPTY)).count() == 0
    assert column(splits.tail_split(series(spark, range(6))), "split", "date") == ["train"] * 4 + ["test"] * 2


def test_folds_never_train_on_the_future(spark):
    out = splits.rolling_origin(series(spark, range(800)), 3)
    ends = out.groupBy("fold", "split").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()
    at = {(r["fold"], r["split"]): r for r in ends}
    for k in (1, 2, 3):
        assert at[k, "train"]["hi"] < at[k, "test"]["lo"]
    assert out.count() == 2400
    assert at[3, "train"]["hi"] == dt.date(2024, 1, 1) + dt.timedelta(days=799 - 90)


def test_learning_prefixes(spark):
    got = splits.learning_prefixes(series(spark, range(100))).groupBy("fraction").count().orderBy("fraction").collect()
    assert [r["count"] for r in got] == [max(20, int(100 * f)) for f in splits.prefix_sizes()]


SAMPLES = "id long, label int"


def _samples(spark, pos, neg):
    return spark.range(pos + neg).select("id", (F.col("id") < pos).cast("int").alias("label"))


@pytest.mark.parametrize("pos,neg,ratio,kept", [(50, 900, 1.0, 50), (50, 900, 2.5, 125), (50, 30, 1.0, 30), (7, 900, 0.0, 0)])
def test_downsample_keeps_the_exact_number(spark, pos, neg, ratio, kept):
    df = _samples(spark, pos, neg)
    out = splits.downsample_negatives(df, ["id"], ratio=ratio)
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {k: v for k, v in ((1, pos), (0, kept)) if v}
    again = splits.downsample_negatives(df.repartition(7), ["id"], ratio=ratio)
    assert column(out, "id", "id") == column(again, "id", "id")


def test_downsample_needs_positives(spark):
    with pytest.raises(Exception, match="no positive"):
        splits.downsample_negatives(_samples(spark, 0, 10), ["id"]).count()


def test_stratified_split_is_exact_per_label(spark):
    out = splits.stratified_split(_samples(spark, 200, 800), "label", ["id"])
    got = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert got == {(1, "train"): 160, (1, "val"): 5, (1, "test"): 35, (0, "train"): 640, (0, "val"): 20, (0, "test"): 140}


def test_shuffle_is_a_permutation(spark):
    out = splits.shuffled(_samples(spark, 50, 50), ["id"])
    assert sorted(column(out, "position", "id")) == list(range(1, 101))
    assert column(out, "position", "id") != list(range(1, 101))
