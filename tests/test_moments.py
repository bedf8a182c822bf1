"""Fits from moments against plain versions, and forecasts that feed on themselves."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import days, series
from ticketspark.operators import forward, models, moments, splits

FEATURES = ["a", "b", "c", "flat", "twice"]


@pytest.fixture(scope="module")
def data():
    rng = random.Random(1)
    out = []
    for s in ("p", "q"):
        for i, d in enumerate(days(300)):
            a, b, c = rng.random() + 2000, rng.random(), rng.gauss(0, 3)
            y = [3 * a - 2 * b + (1 if s == "p" else 4) * c + rng.gauss(0, 0.1) + h for h in (1, 3)]
            out.append((s, d, a, b, c, 0.5, 2 * b, *y, "train" if i < 240 else "test", i // 60))
    return out


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(
        data, "series_id string, date date, a double, b double, c double, flat double, twice double, y_t_plus_1 double, y_t_plus_3 double, split string, fold int"
    )


def plain_fit(rows, k):
    x = np.array([[1, *r[2:5]] for r in rows])
    return np.linalg.lstsq(x, np.array([r[7 + k] for r in rows]), rcond=None)[0]


def test_batched_fits_equal_least_squares(frame, data):
    """Constant and repeated features get no weight; the rest is the plain fit of each group."""
    targets = ["y_t_plus_1", "y_t_plus_3"]
    found = {(r.series_id, r.target): r for r in moments.fit_linear(frame.where("split = 'train'"), FEATURES, targets, ["series_id"]).collect()}
    assert len(found) == 4
    for (s, k), r in found.items():
        wanted = plain_fit([x for x in data if x[0] == s and x[9] == "train"], k)
        assert r.n == 240 and r.weights[3] == 0 and r.weights[4] == 0
        assert np.allclose([r.intercept, *r.weights[:3]], wanted, atol=1e-5)


def test_predictions_are_dated_by_what_they_predict(frame, data):
    preds, _ = moments.train_linear(frame, FEATURES[:3], (1, 3), ["series_id"])
    rows = preds.where("series_id = 'p' and horizon = 3").orderBy("date").collect()
    assert len(rows) == 60 and rows[0].date == data[240][1] + dt.timedelta(days=3)
    assert max(abs(r.y_true - r.y_pred) for r in rows) < 1


def test_no_rows_no_fit(frame):
    assert moments.fit_linear(frame.limit(0), ["a"], ["y_t_plus_1"]).count() == 0
    missing = frame.withColumn("a", F.lit(None).cast("double"))
    assert moments.fit_linear(missing, ["a"], ["y_t_plus_1"], ["series_id"]).count() == 0
    with pytest.raises(ValueError):
        moments.lasso_from_moments(missing, ["a"], "y_t_plus_1", "fold")


def test_backtest_equals_refits(frame):
    got = {(r.fold, r.horizon): (r.mae, r.rmse) for r in moments.backtest_linear(frame, ["b", "c"], (1, 3), 3, 100, 50).collect()}
    assert len(got) == 6
    for h in (1, 3):
        folds = splits.rolling_origin(models.ready(frame.drop("fold"), ["b", "c"], f"y_t_plus_{h}"), 3, 100, 50)
        for fold in (1, 2, 3):
            one = folds.where(F.col("fold") == fold).collect()
            train, test = ([r for r in one if r.split == s] for s in ("train", "test"))
            w = np.linalg.lstsq(np.array([[1, r.b, r.c] for r in train]), np.array([r.label for r in train]), rcond=None)[0]
            e = np.array([r.label - w @ [1, r.b, r.c] for r in test])
            assert np.allclose(got[fold, h], (np.abs(e).mean(), np.sqrt((e * e).mean())), atol=1e-8)


def test_a_stretch_without_rows(frame):
    """Folds whose cutoffs have no row between them share a fit."""
    gap = frame.where("date < '2024-04-10' or date > '2024-09-20'")
    got = {r.fold: r.mae for r in moments.backtest_linear(gap, ["c"], (1,), 3, 100, 50).collect()}
    assert got[1] == pytest.approx(got[2]) and len(got) == 3


def test_lasso_conditions_and_choice(frame, data):
    train = frame.where("split = 'train'")
    model, errors = moments.lasso_from_moments(train, FEATURES, "y_t_plus_1", "fold", 20)
    assert model.penalty == min(errors, key=lambda e: e[1])[0] and len(errors) == 20
    assert model.weights[3] == 0 and model.weights[2] > 1
    assert [r.optimal for r in moments.optimality(train, model, "y_t_plus_1").collect()] == [True] * 5
    wrong = moments.LinearModel(model.features, model.intercept, tuple(1.5 * w for w in model.weights), model.penalty)
    assert not all(r.optimal for r in moments.optimality(train, wrong, "y_t_plus_1").collect())
    # each penalty's error is that of the fit it names
    x = np.array([r[2:5] for r in data if r[9] == "train"])
    y, fold = (np.array([r[i] for r in data if r[9] == "train"]) for i in (7, 10))
    one, plain = moments.lasso_from_moments(train, ["c"], "y_t_plus_1", "fold", 5), []
    s = x[:, 2].std()
    for penalty, _ in one[1]:
        e = []
        for f in range(4):
            z, t = x[fold != f, 2], y[fold != f]
            c = np.cov(z, t, bias=True)[0, 1] / s
            w = np.sign(c) * max(abs(c) - penalty, 0) / (z.var() / s**2) / s
            e.append(np.mean((y[fold == f] - t.mean() - w * (x[fold == f, 2] - z.mean())) ** 2))
        plain.append(np.mean(e))
    assert np.allclose([e for _, e in one[1]], plain)


def test_roll_forward_sees_its_own_days(spark):
    values = [float(i % 7) for i in range(40)]
    model = moments.LinearModel(("y_lag_1", "y_roll7_mean", "late"), 1.0, (0.5, 0.25, 2.0))
    known = lambda on: {"late": (F.dayofmonth(on) > 10).cast("int")}
    both = series(spark, values, name="a").union(series(spark, values[:29], name="short"))
    got = forward.roll_forward(both, model, "y", 5, (1,), ((7, "mean"),), known).orderBy("step").collect()
    now, last = list(values), dt.date(2024, 1, 1) + dt.timedelta(days=39)
    assert {r.series_id for r in got} == {"a"}
    for k, r in enumerate(got, 1):
        on = last + dt.timedelta(days=k)
        now.append(1 + 0.5 * now[-1] + 0.25 * sum(now[-7:]) / 7 + 2.0 * (on.day > 10))
        assert (r.date, r.step) == (on, k) and r.y_pred == pytest.approx(now[-1])
    falling = moments.LinearModel(("y_lag_1",), -5.0, (1.0,))
    assert [r.y_pred for r in forward.roll_forward(both, falling, "y", 3, (1,), ()).orderBy("step").collect()] == [0.0] * 3
    assert forward.roll_forward(both, falling, "y", 2, (1,), (), floor=None).orderBy("step").collect()[1].y_pred == values[-1] - 10
