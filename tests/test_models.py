import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tests.frames import days, rows, series
from ticketspark.functions import metrics
from ticketspark.operators import levels, models
from ticketspark.plans import cells, daily, tickets


@pytest.fixture(scope="module")
def linear_rows(spark):
    rng = random.Random(0)
    data = []
    for d in days(400):
        a, b = rng.random(), rng.random()
        data.append(("s", d, a, b, 0.5, 3 * a - 2 * b + 1))
    df = spark.createDataFrame(data, "series_id string, date date, a double, b double, flat double, y_t_plus_1 double")
    return df.withColumn("split", F.when(F.col("date") < dt.date(2024, 11, 1), "train").otherwise("test"))


FEATURES = ["a", "b", "flat"]


def error(model, df):
    return model.transform(models.ready(df, FEATURES, "y_t_plus_1")).agg(metrics.rmse("label", "prediction")).first()[0]


def test_linear_recovers_coefficients(spark, linear_rows):
    train = models.ready(linear_rows.where("split = 'train'"), FEATURES, "y_t_plus_1")
    model = models.linear(train, FEATURES)
    assert error(model, linear_rows.where("split = 'test'")) < 1e-6


def test_lasso_picks_a_small_penalty_and_drops_nothing_useful(spark, linear_rows):
    train = models.ready(linear_rows.where("split = 'train'"), FEATURES, "y_t_plus_1")
    model = models.lasso_cv(train, FEATURES, alphas=[1.0, 0.001])
    assert error(model, linear_rows.where("split = 'test'")) < 0.01


def test_folds_are_contiguous(spark, linear_rows):
    got = models.contiguous_folds(linear_rows, 5).groupBy("fold").agg(F.min("date"), F.max("date"), F.count("*")).orderBy("fold").collect()
    assert [r[3] for r in got] == [80] * 5
    assert all(got[i][2] < got[i + 1][1] for i in range(4))


def test_trees_beat_the_mean_and_rank_features(spark, linear_rows):
    train = models.ready(linear_rows.where("split = 'train'"), FEATURES, "y_t_plus_1")
    test = linear_rows.where("split = 'test'")
    mean = test.agg(F.stddev_pop("y_t_plus_1")).first()[0]
    for fit in (models.forest(10), models.gbt(10), models.gbt_early_stop(15)):
        assert error(fit(train, FEATURES), test) < mean / 2
    ranked = models.importances(models.forest(10)(train, FEATURES), train, FEATURES).orderBy(F.desc("importance")).collect()
    assert [r["feature"] for r in ranked] == ["a", "b", "flat"]


def test_dealings_are_bijections():
    for n in (1, 2, 6, 30, 97, 210):
        for step, shift in models.dealings(n, 12):
            assert sorted((step * i + shift) % n for i in range(n)) == list(range(n))
    step, _ = models.dealings(1 << 40, 1)[0]
    assert step << 40 < 1 << 63


def test_values_are_dealt_anew(spark):
    rows = [(i, float(i), 10.0 * i, -float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, f"id long, {models.LABEL} double, a double, b double")
    got = models.dealt_anew(df, ["a", "b"], ["id"], 3).collect()
    for repeat in (1, 2, 3):
        for j in (0, 1):
            part = [r for r in got if r["repeat"] == repeat and r["j"] == j]
            assert sorted(r["x"][j] for r in part) == sorted(r[2 + j] for r in rows)
            assert all(r["x"][1 - j] == (10.0, -1.0)[1 - j] * r[models.LABEL] for r in part)
    assert models.dealt_anew(df.limit(0), ["a", "b"], ["id"], 3).count() == 0


def test_permutation_importance(spark, linear_rows):
    df = models.ready(linear_rows, FEATURES, "y_t_plus_1")
    model = models.linear(df, FEATURES)
    got = {r["feature"]: r["importance"] for r in models.permutation_importance(model, df, FEATURES, ["series_id", "date"], 4).collect()}
    assert got["flat"] == pytest.approx(0, abs=1e-9)
    # dealing a feature out anew doubles its part of the variance: 2 * 9 / 13 and 2 * 4 / 13
    assert got["a"] == pytest.approx(18 / 13, rel=0.2) and got["b"] == pytest.approx(8 / 13, rel=0.2)


def test_training_loop_dates_predictions_by_target(spark, linear_rows):
    preds, fitted = models.train_all(linear_rows, {"LinearRegression": models.linear}, FEATURES, [1])
    assert set(fitted) == {("LinearRegression", 1)}
    assert preds.agg(F.min("date")).first()[0] == dt.date(2024, 11, 2)
    assert preds.columns == ["series_id", "date", "split", "y_true", "y_pred", "horizon", "model"]


def test_seasonal_model_follows_an_exact_season(spark):
    values = [10 + (i % 7) * 3 + 0.5 * i + (i * i % 5) * 1e-6 for i in range(120)]
    out = models.seasonal_ar(series(spark, values), "y", F.col("date") < dt.date(2024, 3, 31))
    got = out.where("y_true IS NOT NULL").agg(F.max(F.abs(F.col("y_true") - F.col("y_pred")))).first()[0]
    assert got < 1e-3
    assert {r["horizon"] for r in out.select("horizon").distinct().collect()} == {1, 3, 7}


def test_seasonal_model_does_not_see_the_future(spark):
    rng = random.Random(3)
    values = [rng.randint(0, 20) for _ in range(120)]
    train = F.col("date") < dt.date(2024, 3, 1)
    made_before = dt.date(2024, 4, 1)

    def forecasts(vals):
        out = models.seasonal_ar(series(spark, vals), "y", train)
        return rows(out.where(F.date_sub("date", F.col("horizon")) < made_before).drop("y_true"), "horizon", "date")

    assert forecasts(values) == forecasts(values[:91] + [v + 50 for v in values[91:]])


def _violations(spark, n=900):
    rng = random.Random(8)
    data = []
    for i in range(n):
        hour = 9 if rng.random() < 0.8 else rng.randint(0, 23)
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 60), hours=hour)
        data.append((at.isoformat(sep=" "), 38.9 + rng.randint(0, 3) / 1000, -77.0 + rng.randint(0, 3) / 1000, f"A{i % 3}", f"V{i % 4}"))
    return spark.createDataFrame(data, "Issue_DateTime string, Latitude double, Longitude double, agency string, violation string")


def test_cell_flow_learns_the_busy_hour_and_answers_points(spark):
    events = cells.cell_events(_violations(spark))
    fitted = cells.fit(events)
    assert cells.report(fitted).first()["roc_auc"] > 0.75
    points = spark.createDataFrame(
        [(1, 38.9, -77.0, 9, 0), (2, 38.9, -77.0, 3, 0), (3, 39.02, -76.95, 9, 0), (4, 38.9, -77.0, 24, 0), (5, None, -77.0, 9, 0)],
        "id int, latitude double, longitude double, hour int, day_of_week int",
    )
    got = {r["id"]: r for r in models.predict_points(points, fitted["model"], fitted["cells"], fitted["ranges"], fitted["month_mode"]).collect()}
    assert got[1]["score"] > got[2]["score"]
    assert got[3]["score"] is not None and got[3]["grid_id"] is not None
    assert got[4]["reject"].startswith("hour") and got[4]["score"] is None and got[5]["reject"] == "no coordinates"


def test_weights_score_points_as_the_fitted_model_does(spark):
    fitted = cells.fit(cells.cell_events(_violations(spark)))
    relation = levels.relation_of(fitted["model"], fitted["cells"], models.GEO_CODES, models.GEO_CONTINUOUS)
    points = spark.createDataFrame(
        [(i, 38.9 + i % 5 / 1000, -77.0 + i % 3 / 1000, i % 24, i % 7, 1 + i % 4) for i in range(40)],
        "id int, latitude double, longitude double, hour int, day_of_week int, month int",
    )
    by = [models.predict_points(points, m, fitted["cells"], fitted["ranges"], 1).select("id", "score").collect() for m in (fitted["model"], relation)]
    want, got = ({r.id: r.score for r in x} for x in by)
    assert got == pytest.approx(want, abs=1e-9) and len(got) == 40


def test_level_weights_by_hand(spark):
    samples = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (1, 1, 1), (2, 1, 0), (None, 1, 0), (2, 0, None)], "a int, b int, label int")
    counts = levels.level_counts(samples, ["a", "b"])
    got = {(r.feature, r.level): (r.trials, r.hits) for r in counts.collect()}
    assert got == {("intercept", None): (5, 2), ("a", 1): (3, 2), ("a", 2): (1, 0), ("b", 0): (2, 1), ("b", 1): (3, 1)}
    w = {(r.feature, r.level): r.weight for r in levels.level_weights(counts).collect()}
    p = 2.5 / 6
    base = math.log(p / (1 - p))
    assert w["intercept", None] == pytest.approx(base)
    assert w["a", 2] == pytest.approx(math.log(p / (2 - p)) - base)
    # a level that is not listed and a null one weigh nothing; clashing helper names do not matter
    rows_ = spark.createDataFrame([(1, 7, "x"), (None, 1, "y"), (1, 0, "z")], "a int, b int, name string")
    scored = {r.name: r.score for r in levels.score_by_weights(rows_, levels.level_weights(counts), ["a", "b"]).collect()}
    odds = lambda x: 1 / (1 + math.exp(-x))
    assert scored["x"] == pytest.approx(odds(base + w["a", 1])) and scored["y"] == pytest.approx(odds(base + w["b", 1]))
    assert levels.score_by_weights(rows_.limit(0), levels.level_weights(counts), ["a"]).count() == 0
    nothing = levels.level_weights(levels.level_counts(samples.limit(0), ["a", "b"]))
    assert [r.score for r in levels.score_by_weights(rows_, nothing, ["a"]).select("score").collect()] == [0.5] * 3


def test_ticket_flow_forecasts_and_allocates(spark):
    raw = _violations(spark)
    matrix = tickets.daily_matrix(raw, "agency", "violation")
    assert {"agency_A0", "agency_OTHER", "viol_V3", "ma_7", "lag_7"} <= set(matrix.columns)
    assert matrix.agg(F.sum("tickets")).first()[0] == 900
    test, board, ahead = tickets.fit_and_forecast(matrix, {"LinearRegression": models.linear}, 5, [1, 3])
    assert board.count() == 2 and ahead.count() == 10 and test.count() > 0
    day = matrix.agg(F.max("date")).first()[0]
    assert ahead.agg(F.min("date")).first()[0] == day + dt.timedelta(days=2)
    given = cells.cell_events(raw)
    # a weekday and month without events falls back to mean weights, which need not sum to one
    spread = tickets.allocate_forecast(ahead, given, "LinearRegression", 1).groupBy("date").agg(F.sum("allocated").alias("a"))
    assert spread.count() == ahead.where("horizon = 1").count() and spread.where("a < 0").count() == 0
    # another horizon's forecast of the same dates adds nothing
    twice = ahead.union(ahead.withColumn("horizon", F.lit(9)).select(*ahead.columns))
    again = tickets.allocate_forecast(twice, given, "LinearRegression", 1).groupBy("date").agg(F.sum("allocated").alias("a"))
    assert sorted(r.a for r in again.collect()) == pytest.approx(sorted(r.a for r in spread.collect()))
    lagged = tickets.daily_matrix(raw, "agency", lagged_counts=True)
    assert lagged.orderBy("date").first()["agency_A0"] == 0


def test_daily_flow(spark):
    raw = _violations(spark).withColumn("ts", F.col("Issue_DateTime").cast("timestamp_ntz"))
    table = daily.daily_table(raw, "ts", pivot="agency", top=2)
    names = [c for c in table.columns if c not in ("series_id", "date", "num_violations")]
    assert len(names) == 3 and "OTHER" in names
    features = daily.with_features(table, names)
    rows_ = daily.supervised(features, "2024-02-10", "2024-02-20")
    columns = daily.feature_columns(rows_)
    assert "y_t_plus_1" not in columns and "num_violations" not in columns and "A0_share" in features.columns or "A1_share" in columns
    assert {r[0] for r in rows_.select("split").distinct().collect()} == {"train", "val", "test"}
