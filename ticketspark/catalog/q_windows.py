"""Lags, targets, rolling statistics, sequences and ranks over series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, reshape, spatial, splits, windows
from . import fixtures as fx
from .registry import query, r6, s6

O = "(PARTITION BY series_id ORDER BY date)"


def frame(n: int, offset: int = 0) -> str:
    last = f"{offset} PRECEDING" if offset else "CURRENT ROW"
    return f"(PARTITION BY series_id ORDER BY date ROWS BETWEEN {n - 1 + offset} PRECEDING AND {last})"


def roll(fn: str, n: int, offset: int = 0, at_least: int | None = None, y: str = "num_violations") -> str:
    f = frame(n, offset)
    return f"CASE WHEN count({y}) OVER {f} >= {at_least or n} THEN {fn}({y}) OVER {f} END"


@query(
    "f1_lags",
    f"WITH {fx.DAILY} SELECT series_id, date, {', '.join(f'lag(num_violations, {k}) OVER {O} AS num_violations_lag_{k}' for k in (1, 7, 14, 30))} FROM daily",
)
def lags(spark, d):
    return windows.add_lags(fx.daily(spark, d), "num_violations").drop("num_violations", "is_imputed")


@query(
    "f1_lags_zero_filled",
    f"WITH {fx.DAILY} SELECT series_id, date, {', '.join(f'coalesce(lag(num_violations, {k}) OVER {O}, 0) AS lag_{k}' for k in (1, 3, 7))} FROM daily",
)
def lags_filled(spark, d):
    return windows.add_lags(fx.daily(spark, d), "num_violations", [1, 3, 7], fill=0, name="lag").drop("num_violations", "is_imputed")


@query(
    "f1_lags_28",
    f"WITH {fx.DAILY} SELECT series_id, date, {', '.join(f'lag(num_violations, {k}) OVER {O} AS lag_{k}' for k in range(1, 29))} FROM daily",
)
def lags_28(spark, d):
    return windows.add_lags(fx.daily(spark, d), "num_violations", range(1, 29), name="lag").drop("num_violations", "is_imputed")


@query(
    "f2_lead_targets",
    f"""WITH {fx.DAILY}, t AS (SELECT series_id, date, num_violations, {', '.join(f'lead(num_violations, {h}) OVER {O} AS y_t_plus_{h}' for h in (1, 3, 7))} FROM daily)
SELECT * FROM t WHERE y_t_plus_7 IS NOT NULL""",
)
def targets(spark, d):
    return windows.add_targets(fx.daily(spark, d), "num_violations").drop("is_imputed")


_SEVEN = ", ".join(f"lag(num_violations, {k}) OVER {O} AS lag_{k}" for k in (1, 2, 3)) + ", " + ", ".join(
    f"lead(num_violations, {k}) OVER {O} AS target_{k}" for k in range(1, 8)
)


@query(
    "f2_seven_step_table",
    f"WITH {fx.DAILY}, t AS (SELECT series_id, date, num_violations, {_SEVEN} FROM daily) SELECT * FROM t WHERE lag_3 IS NOT NULL AND target_7 IS NOT NULL",
)
def seven_step(spark, d):
    x = windows.add_lags(fx.daily(spark, d).drop("is_imputed"), "num_violations", [1, 2, 3], name="lag")
    return windows.add_targets(x, "num_violations", range(1, 8), name="target").dropna()


@query(
    "f3_masked_targets",
    f"""WITH {fx.DAILY}, s AS (SELECT *, CASE WHEN date <= DATE '1999-12-31' THEN 'train' WHEN date <= DATE '2000-12-31' THEN 'val' ELSE 'test' END AS split FROM daily),
t AS (SELECT series_id, date, split, {', '.join(f'lead(num_violations, {h}) OVER (PARTITION BY series_id, split ORDER BY date) AS t{h}' for h in (1, 3, 7))} FROM s)
SELECT series_id, date, split, {', '.join(f'CAST(coalesce(t{h}, 0) AS BIGINT) AS label_{h}, CAST(t{h} IS NOT NULL AS INTEGER) AS mask_{h}' for h in (1, 3, 7))} FROM t""",
)
def masked(spark, d):
    x = splits.chrono_split(fx.daily(spark, d), fx.TRAIN_END, fx.VAL_END)
    return windows.target_mask(x, "num_violations").drop("num_violations", "is_imputed")


@query(
    "f4_daily_rolling_features",
    f"""WITH {fx.DAILY} SELECT series_id, date, num_violations, lag(num_violations, 1) OVER {O} AS num_violations_lag_1,
  lag(num_violations, 7) OVER {O} AS num_violations_lag_7,
  {s6(roll("avg", 7), "num_violations_roll7_mean")}, {s6(roll("avg", 30), "num_violations_roll30_mean")},
  {s6(roll("stddev_samp", 30), "num_violations_roll30_std")} FROM daily""",
)
def rolling(spark, d):
    x = windows.add_lags(fx.daily(spark, d), "num_violations", [1, 7])
    x = windows.add_rolling(x, "num_violations")
    names = [f"num_violations_roll{n}_{s}" for n, s in windows.DAILY_ROLLING]
    return x.select("series_id", "date", "num_violations", "num_violations_lag_1", "num_violations_lag_7", *[r6(c, c) for c in names])


_SAFE = [(n, s) for n in (7, 14, 28) for s in ("mean", "std")]


@query(
    "f5_leakage_safe_rolling",
    f"WITH {fx.DAILY} SELECT series_id, date, "
    + ", ".join(s6(roll("avg" if s == "mean" else "stddev_samp", n, 1), f"roll{n}_{s}") for n, s in _SAFE)
    + " FROM daily",
)
def safe_rolling(spark, d):
    x = windows.add_rolling(fx.daily(spark, d), "num_violations", _SAFE, offset=1, name="y")
    return x.select("series_id", "date", *[r6(f"y_roll{n}_{s}", f"roll{n}_{s}") for n, s in _SAFE])


@query("f6_rolling_min_periods", f"WITH {fx.DAILY} SELECT series_id, date, {s6(roll('avg', 7, 0, 1), 'ma_7')} FROM daily")
def min_periods(spark, d):
    x = windows.add_rolling(fx.daily(spark, d), "num_violations", [(7, "mean")], min_periods=1, name="y")
    return x.select("series_id", "date", r6("y_roll7_mean", "ma_7"))


@query(
    "f7_rate_of_change",
    f"""WITH {fx.DAILY}, m AS (SELECT series_id, date, num_violations AS y, {roll("avg", 7)} AS m FROM daily)
SELECT series_id, date, {s6("(y - m) / (m + 1e-6)", "roc")} FROM m""",
)
def roc(spark, d):
    x = windows.add_rolling(fx.daily(spark, d), "num_violations", [(7, "mean")], name="y")
    return x.select("series_id", "date", r6(windows.rate_of_change("num_violations", "y_roll7_mean"), "roc"))


@query(
    "f8_naive_scale",
    f"""WITH {fx.DAILY}, s AS (SELECT series_id, abs(num_violations - lag(num_violations) OVER {O}) AS step FROM daily WHERE date <= DATE '1999-12-31')
SELECT series_id, {s6("avg(step)", "naive_scale")} FROM s GROUP BY 1""",
)
def naive(spark, d):
    x = windows.naive_scale(fx.daily(spark, d), "num_violations", F.col("date") <= F.lit(fx.TRAIN_END).cast("date"))
    return x.select("series_id", r6("naive_scale", "naive_scale"))


@query(
    "f9_seasonal_difference",
    f"""WITH {fx.DAILY} SELECT series_id, date, (num_violations - lag(num_violations) OVER {O}) - (lag(num_violations, 7) OVER {O} - lag(num_violations, 8) OVER {O}) AS diff
FROM daily""",
)
def difference(spark, d):
    return windows.difference(fx.daily(spark, d), "num_violations").select("series_id", "date", "diff")


@query(
    "f10_lookback_sequences",
    f"""WITH {fx.DAILY}, s AS (SELECT series_id, date, list(CAST(num_violations AS DOUBLE)) OVER (PARTITION BY series_id ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS history,
  CAST(num_violations AS DOUBLE) AS t1, CAST(lead(num_violations, 2) OVER {O} AS DOUBLE) AS t3, CAST(lead(num_violations, 6) OVER {O} AS DOUBLE) AS t7, lead(date, 6) OVER {O} AS label_date FROM daily)
SELECT series_id, date, label_date, array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN history], ',') AS history,
  array_to_string([CAST(CAST(t1 AS BIGINT) AS VARCHAR), CAST(CAST(t3 AS BIGINT) AS VARCHAR), CAST(CAST(t7 AS BIGINT) AS VARCHAR)], ',') AS targets
FROM s WHERE len(history) = 30 AND label_date IS NOT NULL""",
)
def sequences(spark, d):
    x = windows.sequences(fx.daily(spark, d), "num_violations")

    def text(c):
        return F.array_join(F.transform(c, lambda v: v.cast("long").cast("string")), ",").alias(c)

    return x.select("series_id", "date", "label_date", text("history"), text("targets"))


@query(
    "f11_winner_per_horizon",
    f"""WITH {fx.PREDS}, {fx.BOARD} SELECT horizon, model, {s6("mae", "mae")}, {s6("rmse", "rmse")} FROM
(SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY mae, model) AS rn FROM board) WHERE rn = 1""",
)
def winners(spark, d):
    b = evaluate.summarize(fx.predictions(spark, d).where("split = 'test'"), ["horizon", "model"])
    return evaluate.winners(b).select("horizon", "model", r6("mae", "mae"), r6("rmse", "rmse"))


@query(
    "f12_worst_days",
    f"""WITH {fx.PREDS}, e AS (SELECT series_id, date, horizon, abs(y_true - y_pred) AS abs_err FROM preds WHERE split = 'test' AND model = 'mean7'),
r AS (SELECT *, row_number() OVER (PARTITION BY horizon ORDER BY abs_err DESC, date, series_id) AS rank FROM e)
SELECT series_id, date, horizon, {s6("abs_err", "abs_err")}, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
)
def worst(spark, d):
    p = fx.predictions(spark, d).where("split = 'test' AND model = 'mean7'")
    x = evaluate.worst_days(p, 10, ties=["date", "series_id"])
    return x.select("series_id", "date", "horizon", r6("abs_err", "abs_err"), "rank")


@query(
    "f13_tail_rows",
    f"""WITH {fx.DAILY}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS rn FROM daily)
SELECT series_id, date, num_violations FROM r WHERE rn <= 90""",
)
def tail(spark, d):
    return windows.tail_rows(fx.daily(spark, d), 90).select("series_id", "date", "num_violations")


@query(
    "f14_days_since_start",
    f"""WITH {fx.DAILY} SELECT series_id, date, CAST(date - min(date) OVER (PARTITION BY series_id) AS INTEGER) AS days_since_start FROM daily""",
)
def days(spark, d):
    return windows.days_since_start(fx.daily(spark, d)).select("series_id", "date", "days_since_start")


@query(
    "f15_dense_cell_ids",
    f"""WITH {fx.CELLS}, c AS (SELECT DISTINCT lat_id, lon_id FROM cell_events)
SELECT lat_id, lon_id, row_number() OVER (ORDER BY lat_id, lon_id) - 1 AS grid_id FROM c""",
)
def cells(spark, d):
    return spatial.cell_ids(fx.cell_events(spark, d))


@query(
    "l12_multi_target_table",
    f"""WITH {fx.DAILY}, t AS (SELECT series_id, date, num_violations, {', '.join(f'lead(num_violations, {h}) OVER {O} AS y{h}' for h in (1, 3, 7))} FROM daily)
SELECT series_id, date, num_violations, CAST(h AS INTEGER) AS horizon, CAST(CASE h WHEN 1 THEN y1 WHEN 3 THEN y3 ELSE y7 END AS DOUBLE) AS y
FROM t, (SELECT unnest([1, 3, 7]) AS h) WHERE y7 IS NOT NULL""",
)
def multi_target(spark, d):
    x = windows.add_targets(fx.daily(spark, d), "num_violations").drop("is_imputed")
    return reshape.multi_target(x, ["series_id", "date"], [1, 3, 7])
