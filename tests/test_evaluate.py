import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.frames import column, rows
from ticketspark.operators import evaluate, ordering, spatial
from ticketspark.plans import evaluation

PRED = "date date, horizon int, split string, model string, y_true double, y_pred double"


def preds(spark, items):
    d = dt.date(2024, 1, 1)
    return spark.createDataFrame([(d + dt.timedelta(days=i), h, s, m, float(y), float(p)) for i, (h, s, m, y, p) in enumerate(items)], PRED)


def test_winner_and_worst_days_break_ties(spark):
    p = preds(spark, [(1, "test", "b", 5, 4), (1, "test", "a", 5, 4), (1, "test", "a", 5, 6), (1, "test", "b", 5, 6)])
    board = evaluate.summarize(p, ["horizon", "model"])
    assert evaluate.winners(board).first()["model"] == "a"
    worst = evaluate.worst_days(p, 2)
    assert column(worst, "date", "rank") == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_improvement_without_baseline_is_left_out(spark):
    board = spark.createDataFrame([(1, "GBDT", 2.0), (1, "X", 1.5), (3, "X", 1.0)], "horizon int, model string, mae double")
    out = rows(evaluate.improvement(board))
    assert out == [(1, "GBDT", 2.0, "X", 1.5, 0.5, 25.0)]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(-30, 30), min_size=1, max_size=120), st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_quantiles_equal_numpy(spark, values, q):
    df = spark.createDataFrame([("g", float(v)) for v in values] + [("h", 1.0)], "k string, v double")
    got = {r["k"]: r["q"] for r in ordering.exact_quantiles(df, "v", {"q": q}, ["k"]).collect()}
    assert got["g"] == pytest.approx(np.quantile(values, q)) and got["h"] == 1.0
    whole = ordering.exact_quantiles(df, "v", {"q": q}).first()["q"]
    assert whole == pytest.approx(np.quantile([*values, 1], q))


def test_quantiles_of_a_large_skewed_group(spark):
    n = 200_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.exp(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 700.0)).alias("v"))
    values = np.array([r["v"] for r in df.collect()])
    got = ordering.exact_quantiles(df, "v", {"a": 0.05, "b": 0.5, "c": 0.9, "d": 0.999}).first()
    for name, q in (("a", 0.05), ("b", 0.5), ("c", 0.9), ("d", 0.999)):
        assert got[name] == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_medians_of_many_groups(spark):
    random.seed(5)
    data = [(random.randint(0, 6), float(random.randint(0, 9)), random.random()) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, a double, b double")
    got = ordering.group_medians(df, ["k"], ["a", "b"]).collect()
    for r in got:
        assert r["a"] == pytest.approx(np.median([a for k, a, _ in data if k == r["k"]]))
        assert r["b"] == pytest.approx(np.median([b for k, _, b in data if k == r["k"]]))


def test_conformal_band_covers_its_validation_rows(spark):
    rng = random.Random(2)
    val = preds(spark, [(1, "val", "m", 10, 10 + rng.gauss(0, 3)) for _ in range(57)])
    bands = evaluate.conformal(val, val)
    got = evaluate.coverage(bands).first()["empirical"]
    assert got >= (math.floor(0.9 * 56) + 1) / 57 - 1e-12


def test_scale_needs_five_rows(spark):
    few = preds(spark, [(1, "val", "m", 4, 2)] * 4 + [(3, "val", "m", 4, 2)] * 5)
    got = {r["horizon"]: r["scale"] for r in evaluate.fit_scale(few).collect()}
    assert got[1] == 1.0 and got[3] == pytest.approx(2.0)


def test_histogram_counts_everything(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("a", 9.99), ("b", 5.0)], "k string, v double")
    out = evaluate.histogram(df, "v", 5, ["k"])
    assert out.count() == 10
    assert column(out.where("k = 'a'"), "n", "bin") == [1, 0, 0, 0, 2]
    one = evaluate.histogram(df.where("k = 'b'"), "v", 4)
    assert one.agg(F.sum("n")).first()[0] == 1 and column(one, "left_edge", "bin")[0] == 4.5


def test_ranking_scores_with_ties(spark):
    rng = random.Random(4)
    data = [(rng.randint(0, 1), rng.randint(0, 12) / 12) for _ in range(400)]
    got = evaluate.ranking_scores(spark.createDataFrame(data, "label int, score double")).first()
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for t in sorted({s for _, s in data}, reverse=True):
        tp = sum(s >= t for s in pos)
        ap += (tp / len(pos) - last) * tp / (tp + sum(s >= t for s in neg))
        last = tp / len(pos)
    assert got["roc_auc"] == pytest.approx(auc) and got["average_precision"] == pytest.approx(ap)


def test_class_report(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1), (0, 0.2)], "label int, score double")
    got = {r["class"]: r for r in evaluate.class_report(df).collect()}
    assert (got[1]["precision"], got[1]["recall"], got[1]["support"]) == (0.5, 0.5, 2)
    assert got[0]["precision"] == pytest.approx(2 / 3) and got[0]["support"] == 3


@pytest.mark.parametrize("block", [4096, 16])
def test_bootstrap_draws_each_row_about_once(spark, block):
    p = preds(spark, [(1, "test", "m", i, 0) for i in range(60)])
    boot = evaluate.bootstrap(p, ["model"], ["date"], 300, block=block)
    assert boot.count() == 300
    got = boot.agg(F.avg("mae"), F.stddev_samp("mae")).first()
    spread = np.std(np.arange(60)) / math.sqrt(60)
    assert got[0] == pytest.approx(29.5, abs=4 * spread / math.sqrt(300))
    assert got[1] == pytest.approx(spread, rel=0.2)


def test_interval_holds_the_point_estimate(spark):
    rng = random.Random(1)
    p = preds(spark, [(1, "test", "m", 10, 10 + rng.gauss(0, 2)) for _ in range(80)])
    r = evaluate.bootstrap_ci(p, replicates=200).first()
    assert r["mae_lo"] < r["mae"] < r["mae_hi"] and r["rmse_lo"] < r["rmse"] < r["rmse_hi"] and r["n"] == 80


def test_weights_and_allocation(spark):
    e = spark.createDataFrame(
        [(0, 1, 1, 1), (0, 1, 1, 1), (0, 1, 2, 2), (1, 1, 2, 2)], "day_of_week int, month int, lat_id long, lon_id long"
    )
    w = spatial.spatial_weights(e)
    sums = w.groupBy("day_of_week", "month").agg(F.sum("weight").alias("s"))
    assert all(r["s"] == pytest.approx(1.0) for r in sums.collect())
    f = spark.createDataFrame([(dt.date(2024, 1, 1), 9.0), (dt.date(2024, 1, 2), -3.0), (dt.date(2024, 7, 3), 6.0)], "date date, y_pred double")
    got = {(r["date"].day, r["lat_id"]): r["allocated"] for r in spatial.allocate(f, w).collect()}
    assert got[1, 1] == pytest.approx(6.0) and got[1, 2] == pytest.approx(3.0)
    assert got[2, 2] == 0.0
    assert got[3, 1] == pytest.approx(6.0 * 2 / 3) and got[3, 2] == pytest.approx(6.0 * (1 / 3 + 1) / 2)


@pytest.mark.parametrize("fan", [2, 8])
def test_nearest_cell_equals_brute_force(spark, fan):
    rng = random.Random(fan)
    known = sorted({(rng.randint(0, 300), rng.randint(-200, 100)) for _ in range(60)})
    places = {(rng.randint(-50, 400), rng.randint(-300, 200)) for _ in range(80)} | set(known[:5])
    cells = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(known)], "lat_id long, lon_id long, grid_id long")
    points = spark.createDataFrame(list(places), "lat_id long, lon_id long")
    got = {(r["lat_id"], r["lon_id"]): r["grid_id"] for r in spatial.nearest_cells(points, cells, fan).collect()}
    for a, b in places:
        assert got[a, b] == min(range(len(known)), key=lambda i: ((known[i][0] - a) ** 2 + (known[i][1] - b) ** 2, i))


def test_snap_with_one_cell_and_with_none(spark):
    points = spark.createDataFrame([(1, 1), (9, 9)], "lat_id long, lon_id long")
    one = spark.createDataFrame([(5, 5, 0)], "lat_id long, lon_id long, grid_id long")
    assert column(spatial.snap_to_cell(points, one), "grid_id", "lat_id") == [0, 0]
    assert column(spatial.snap_to_cell(points, one.limit(0)), "grid_id", "lat_id") == [None, None]


def test_cell_ids_are_dense_and_ordered(spark):
    e = spark.createDataFrame([(2, 1), (1, 9), (1, 3), (2, 1), (5, 0)], "lat_id long, lon_id long")
    assert rows(spatial.cell_ids(e), "grid_id") == [(1, 3, 0), (1, 9, 1), (2, 1, 2), (5, 0, 3)]


def test_report_tables(spark):
    rng = random.Random(0)
    items = [(h, s, m, 5 + rng.random(), 5 + rng.random()) for h in (1, 3) for s in ("val", "test") for m in ("A", "GBDT") for _ in range(12)]
    out = evaluation.report(preds(spark, items), banded="A", replicates=20)
    assert out["leaderboards"].count() == 2 + 4 + 8
    assert all(t.count() > 0 for t in out.values())
