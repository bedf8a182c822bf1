"""Splits, folds and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate, densify, evaluate, splits
from ..session import materialize
from . import fixtures as fx
from .q_densify import _VISITED
from .registry import query, r6, s6

_POS = """pos AS (SELECT series_id, date, row_number() OVER (PARTITION BY series_id ORDER BY date) AS i, count(*) OVER (PARTITION BY series_id) AS n FROM daily)"""


@query(
    "h1_chronological_split",
    f"""WITH {fx.DAILY} SELECT series_id, date, CASE WHEN date <= DATE '1999-12-31' THEN 'train' WHEN date <= DATE '2000-12-31' THEN 'val' ELSE 'test' END AS split FROM daily""",
)
def chrono(spark, d):
    return splits.chrono_split(fx.daily(spark, d), fx.TRAIN_END, fx.VAL_END).select("series_id", "date", "split")


@query(
    "h2_fraction_split",
    f"""WITH {fx.DAILY}, {_POS}, k AS (SELECT *, greatest(1, floor(n * CAST(0.3 AS DOUBLE))) AS t FROM pos),
v AS (SELECT *, greatest(1, floor((n - t) * CAST(0.1 AS DOUBLE))) AS v FROM k)
SELECT series_id, date, CASE WHEN i > n - t THEN 'test' WHEN i > n - t - v THEN 'val' ELSE 'train' END AS split FROM v""",
)
def fraction(spark, d):
    return splits.fraction_split(fx.daily(spark, d)).select("series_id", "date", "split")


@query(
    "h2_head_split",
    f"""WITH {fx.DAILY}, {_POS} SELECT series_id, date,
  CASE WHEN i <= floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN i <= floor(n * (CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE))) THEN 'val' ELSE 'test' END AS split FROM pos""",
)
def head(spark, d):
    return splits.head_split(fx.daily(spark, d)).select("series_id", "date", "split")


@query(
    "h2_tail_split",
    f"""WITH {fx.DAILY}, {_POS} SELECT series_id, date, CASE WHEN i > n - ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM pos""",
)
def tail(spark, d):
    return splits.tail_split(fx.daily(spark, d)).select("series_id", "date", "split")


_KEY = fx.key_hash_sql("date", "lat_id", "lon_id", "hour")
_SAMPLE_KEY = ["date", "lat_id", "lon_id", "hour"]


@query(
    "h3_stratified_split",
    f"""WITH {_VISITED}, r AS (SELECT date, lat_id, lon_id, hour, label, count(*) OVER (PARTITION BY label) AS n,
  row_number() OVER (PARTITION BY label ORDER BY {_KEY}, date, lat_id, lon_id, hour) AS i FROM samples),
c AS (SELECT *, ceil(n * CAST(0.2 AS DOUBLE)) AS held FROM r)
SELECT date, lat_id, lon_id, hour, label,
  CASE WHEN i <= n - held THEN 'train' WHEN i <= n - held + floor(held * CAST(0.125 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM c""",
)
def stratified(spark, d):
    s = densify.visited_grid(fx.cell_events(spark, d))
    return splits.stratified_split(s, "label", _SAMPLE_KEY).drop("ticket_count")


@query(
    "h4_downsample_negatives",
    f"""WITH {_VISITED}, r AS (SELECT date, lat_id, lon_id, hour, label,
  row_number() OVER (PARTITION BY label ORDER BY {_KEY}, date, lat_id, lon_id, hour) AS i FROM samples)
SELECT date, lat_id, lon_id, hour, label FROM r WHERE label = 1 OR i <= (SELECT sum(label) FROM samples)""",
)
def downsample(spark, d):
    s = densify.visited_grid(fx.cell_events(spark, d)).drop("ticket_count")
    return splits.downsample_negatives(s, _SAMPLE_KEY)


@query(
    "h5_rolling_origin",
    f"""WITH {fx.DAILY}, m AS (SELECT min(date) + 365 AS lo, max(date) - 90 AS hi FROM daily),
f AS (SELECT CAST(k AS INTEGER) AS fold, CAST(lo + CAST((hi - lo) * k // 3 AS INTEGER) AS DATE) AS cutoff FROM m, (SELECT unnest([1, 2, 3]) AS k))
SELECT series_id, date, fold, cutoff, CASE WHEN date <= cutoff THEN 'train' ELSE 'test' END AS split FROM daily, f""",
)
def folds(spark, d):
    return splits.rolling_origin(fx.daily(spark, d)).select("series_id", "date", "fold", "cutoff", "split")


_FR = ", ".join(repr(f) + "::DOUBLE" for f in splits.prefix_sizes())


@query(
    "h6_learning_prefixes",
    f"""WITH {fx.DAILY}, {_POS}, p AS (SELECT unnest([{_FR}]) AS fraction)
SELECT series_id, round(fraction, 6) AS fraction, count(*) AS n, max(date) AS last_date FROM pos, p WHERE i <= greatest(20, floor(n * fraction)) GROUP BY 1, 2""",
)
def prefixes(spark, d):
    x = splits.learning_prefixes(fx.daily(spark, d).select("series_id", "date"))
    return x.groupBy("series_id", F.round("fraction", 6).alias("fraction")).agg(
        F.count(F.lit(1)).alias("n"), F.max("date").alias("last_date")
    )


_BKEY = fx.key_hash_sql("series_id", "date")
_P = 2147483647


def _mix(source: str, slot: str, stream: str, seed: int, out: str) -> str:
    """The CTE ``out``: ``source`` with the pseudo-random column x."""
    return f"""{out}1 AS (SELECT *, {slot} % {_P} AS a_, ({stream}) % {_P} AS b_ FROM {source}),
{out}2 AS (SELECT *, (a_ * 48271 + b_ * 69621 + {seed} * 16807 + 12345) % {_P} AS x FROM {out}1),
{out}3 AS (SELECT * REPLACE ((x * x + b_) % {_P} AS x) FROM {out}2),
{out}4 AS (SELECT * REPLACE ((x * 40692 + a_) % {_P} AS x) FROM {out}3),
{out} AS (SELECT * REPLACE ((x * x + a_) % {_P} AS x) FROM {out}4)"""


def _boot(b: int) -> str:
    g = "split, model, horizon"
    return f"""{fx.PREDS},
rows_ AS (SELECT {g}, y_true - y_pred AS e,
  row_number() OVER (PARTITION BY {g} ORDER BY {_BKEY}, series_id, date) AS i, count(*) OVER (PARTITION BY {g}) AS n FROM preds),
sizes AS (SELECT {g}, (i - 1) // 4096 AS block, count(*) AS size FROM rows_ GROUP BY ALL),
x0 AS (SELECT {g}, n, i - 1 AS slot, CAST(b AS BIGINT) AS b FROM rows_, (SELECT unnest(generate_series(1, {b})) AS b)),
{_mix("x0", "slot", "b", 42, "xa")},
hits AS (SELECT {g}, b, (x % n) // 4096 AS block, count(*) AS draws FROM xa GROUP BY ALL),
y0 AS (SELECT {g}, b, block, unnest(generate_series(1, draws)) AS j FROM hits),
{_mix("y0", "j", "b * 1000003 + block", 43, "ya")},
boot AS (SELECT {g}, y.b AS replicate, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse
  FROM ya y JOIN sizes s USING ({g}, block) JOIN rows_ r USING ({g}) WHERE r.i = block * 4096 + x % size + 1 GROUP BY ALL)"""


@query(
    "h7_bootstrap_resample",
    f"WITH {_boot(20)} SELECT split, model, horizon, CAST(replicate AS INTEGER) AS replicate, {s6('mae', 'mae')}, {s6('rmse', 'rmse')} FROM boot",
)
def bootstrap(spark, d):
    x = evaluate.bootstrap(fx.predictions(spark, d), ["split", "model", "horizon"], ["series_id", "date"], 20)
    return x.select("split", "model", "horizon", "replicate", r6("mae", "mae"), r6("rmse", "rmse"))


@query(
    "m14_bootstrap_interval",
    f"""WITH {_boot(100)}, p AS (SELECT split, model, horizon, avg(abs(y_true - y_pred)) AS mae, sqrt(avg(power(y_true - y_pred, 2))) AS rmse, count(*) AS n FROM preds GROUP BY 1, 2, 3),
q AS (SELECT split, model, horizon, quantile_cont(mae, 0.025) AS a, quantile_cont(mae, 0.975) AS b, quantile_cont(rmse, 0.025) AS c, quantile_cont(rmse, 0.975) AS d FROM boot GROUP BY 1, 2, 3)
SELECT p.split, p.model, p.horizon, {s6("mae", "mae")}, {s6("a", "mae_lo")}, {s6("b", "mae_hi")}, {s6("rmse", "rmse")}, {s6("c", "rmse_lo")}, {s6("d", "rmse_hi")}, n
FROM p JOIN q ON p.split = q.split AND p.model = q.model AND p.horizon = q.horizon""",
)
def bootstrap_interval(spark, d):
    preds = materialize(fx.predictions(spark, d), "predictions")
    x = evaluate.bootstrap_ci(preds, key=["series_id", "date"], replicates=100)
    return x.select("split", "model", "horizon", *[r6(c, c) for c in ("mae", "mae_lo", "mae_hi", "rmse", "rmse_lo", "rmse_hi")], "n")


@query(
    "h8_seeded_shuffle",
    f"""WITH {fx.CELLS} SELECT event_id, row_number() OVER (ORDER BY {fx.key_hash_sql("event_id", seed=7)}, event_id) AS position FROM cell_events""",
)
def shuffle(spark, d):
    return splits.shuffled(fx.cell_events(spark, d).select("event_id"), ["event_id"], 7)


_CODE = fx.CELLS + """, c AS (SELECT event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS code
  FROM (SELECT DISTINCT event_type FROM cell_events WHERE date <= DATE '2024-01-20' AND event_type <> 'error'))"""


@query(
    "x14_category_codes",
    f"""WITH {_CODE} SELECT event_id, CAST(coalesce(code, -1) AS INTEGER) AS code FROM cell_events e LEFT JOIN c ON e.event_type = c.event_type""",
)
def codes(spark, d):
    e = fx.cell_events(spark, d)
    fitted = aggregate.fit_codes(e.where("date <= DATE '2024-01-20' AND event_type <> 'error'"), "event_type")
    return aggregate.apply_codes(e, fitted, "event_type", "code").select("event_id", "code")
