"""Exact ranks, cut points and quantiles without sorting a group on one task.

The order is cut into ranges. Range sizes are small tables; their running totals say where each
range starts, and only rows within a range are ordered against each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket, key_hash
from ..session import materialize
from .joins import attach


def _starts(df: DataFrame, by: Sequence[str], bucket: str) -> DataFrame:
    """Rows per range, the rows before it and the rows of the whole group.

    The window sees one row per range (at most the number of ranges), never the data.
    """
    sizes = df.groupBy(*by, bucket).agg(F.count(F.lit(1)).alias("_size"))
    w = Window.partitionBy(*by)
    return sizes.withColumns(
        {
            "_before": F.sum("_size").over(w.orderBy(bucket)) - F.col("_size"),
            "_total": F.sum("_size").over(w),
        }
    )


def ranked(
    df: DataFrame, by: Sequence[str], bucket: Column, order: Sequence[Column], rank: str = "rank", total: str = "group_rows"
) -> DataFrame:
    """Row number within ``by``, and the group size.

    ``bucket`` must rise with ``order``. A group is spread over its buckets.
    """
    rows = df.withColumn("_bucket", bucket)
    w = Window.partitionBy(*by, "_bucket").orderBy(*order)
    numbered = rows.withColumn("_rn", F.row_number().over(w))
    joined = numbered.join(_starts(rows, by, "_bucket"), [*by, "_bucket"])
    return joined.withColumns({rank: F.col("_before") + F.col("_rn"), total: F.col("_total")}).drop(
        "_bucket", "_rn", "_size", "_before", "_total"
    )


def hash_ranked(df: DataFrame, key: Sequence[str], by: Sequence[str] = (), seed: int = 42, **names: str) -> DataFrame:
    """Reproducible random row number within ``by``; ``key`` names unique columns."""
    h = key_hash(*[F.col(k) for k in key], seed=seed)
    rows = df.withColumn("_hash", h)
    order = [F.col("_hash"), *[F.col(k) for k in key]]
    return ranked(rows, by, hash_bucket(F.col("_hash")), order, **names).drop("_hash")


def hash_cuts(
    df: DataFrame, key: Sequence[str], wanted: dict[str, Column], by: Sequence[str] = (), seed: int = 42
) -> DataFrame:
    """Per group, the order value of the row at each wanted rank.

    ``wanted`` maps a name to a rank given as a column over ``n``, the group size. A cut is null when
    its rank is below one, and the largest value when it is at or above n. One row per group comes
    back, so a sample is a filter against it: no row of the data is moved to be sampled. Runs the job
    that finds the ranges holding the wanted ranks.
    """
    rows = df.select(*dict.fromkeys([*by, *key])).withColumn("_hash", key_hash(*[F.col(k) for k in key], seed=seed))
    rows = rows.withColumn("_bucket", hash_bucket(F.col("_hash")))
    starts = _starts(rows, by, "_bucket").withColumn("n", F.col("_total"))
    goals = F.array(*[F.struct(F.lit(name).alias("cut"), F.least(rank.cast("long"), F.col("n")).alias("goal")) for name, rank in wanted.items()])
    edges = starts.select(*by, "_bucket", "_before", "_size", F.inline(goals))
    edges = edges.where((F.col("goal") > F.col("_before")) & (F.col("goal") <= F.col("_before") + F.col("_size")))
    edge_rows = attach(rows, edges, [*by, "_bucket"], "inner")
    order = F.struct("_hash", *key)
    w = Window.partitionBy(*by, "cut").orderBy(order)
    hit = edge_rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == F.col("goal") - F.col("_before"))
    cols = [F.max(F.when(F.col("cut") == name, order)).alias(name) for name in wanted]
    return hit.groupBy(*by).agg(*cols)


def order_value(key: Sequence[str], seed: int = 42) -> Column:
    """What ``hash_cuts`` compares."""
    return F.struct(key_hash(*[F.col(k) for k in key], seed=seed).alias("_hash"), *key)


def in_ranges(df: DataFrame, order: str, out: str = "_range") -> DataFrame:
    """Rows with the number of their range, ranges rising with ``order``. Runs the job that writes them.

    A range is a partition of Spark's own range shuffle. Writing the rows fixes its number, so later
    stages agree on it whatever is run again.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, order).withColumn(out, F.spark_partition_id()), "ranges")


def dense_ids(values: DataFrame, col: str, out: str) -> DataFrame:
    """Position from 0 of each of many distinct values in sorted order."""
    rows = in_ranges(values, col)
    numbered = ranked(rows, (), F.col("_range"), [F.col(col)], out, "_n")
    return numbered.select(*values.columns, (F.col(out) - 1).alias(out))


def running_sums(df: DataFrame, order: str, sums: Sequence[str], descending: bool = False) -> DataFrame:
    """Totals of all rows up to and including each one, in the order of a column.

    Adds ``cum_<name>``. Order values must be unique (aggregate by them first). Totals of whole
    ranges give each range its start, and rows are only ordered within their range.
    """
    rows = in_ranges(df, order)
    per_range = rows.groupBy("_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    step = F.desc if descending else F.asc
    # one row per range here, so this window without keys holds as many rows as there are shuffle partitions
    outer = Window.partitionBy(F.lit(1)).orderBy(step("_range"))
    starts = per_range.select("_range", *[(F.sum(f"_t_{s}").over(outer) - F.col(f"_t_{s}")).alias(f"_b_{s}") for s in sums])
    inner = Window.partitionBy("_range").orderBy(step(order))
    within = rows.withColumns({f"_w_{s}": F.sum(s).over(inner) for s in sums})
    joined = within.join(F.broadcast(starts), "_range")
    return joined.withColumns({f"cum_{s}": F.col(f"_b_{s}") + F.col(f"_w_{s}") for s in sums}).select(
        *df.columns, *[f"cum_{s}" for s in sums]
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Linear-interpolated quantiles per group, exact at any group size.

    A sketch brackets each quantile within a few parts in ``accuracy``. Values below the bracket only
    count; the few within it are ordered. Equal values are collapsed before anything is moved. Should
    a bracket miss its rank the query fails instead of returning a wrong number.
    """
    v = df.select(*by, F.col(value).cast("double").alias("_v"))
    v = v.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    margin = 4.0 / accuracy
    marks = [m for p in probs.values() for m in (max(0.0, p - margin), min(1.0, p + margin))]
    bounds = v.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", marks, accuracy).alias("_marks")
    )
    counts = v.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    if by:
        marked = attach(counts, bounds, list(by), "inner")
    else:
        one = bounds.select(F.struct("_n", "_marks")).scalar()
        marked = counts.withColumn("_one", one).select("_v", "_c", F.col("_one._n").alias("_n"), F.col("_one._marks").alias("_marks"))
    # up to ``accuracy`` rows the bracket is the whole group; above, its margin is four ranks or more
    small = F.col("_n") <= accuracy
    wanted = F.array(
        *[
            F.struct(
                F.lit(name).alias("_q"),
                (F.lit(float(p)) * (F.col("_n") - 1)).alias("_pos"),
                F.when(small, F.lit(float("-inf"))).otherwise(F.col("_marks")[2 * i]).alias("_lo"),
                F.when(small, F.lit(float("inf"))).otherwise(F.col("_marks")[2 * i + 1]).alias("_hi"),
            )
            for i, (name, p) in enumerate(probs.items())
        ]
    )
    rows = marked.select(*by, "_v", "_c", F.inline(wanted)).where(F.col("_v") <= F.col("_hi"))
    held = F.when(F.col("_v") < F.col("_lo"), F.lit(float("-inf"))).otherwise(F.col("_v"))
    groups = rows.groupBy(*by, "_q", held.alias("_v")).agg(F.sum("_c").alias("_c"), F.first("_pos").alias("_pos"))
    w = Window.partitionBy(*by, "_q").orderBy("_v")
    cum = groups.withColumn("_cum", F.sum("_c").over(w))
    lo_rank, hi_rank = F.floor("_pos") + 1, F.ceil("_pos") + 1
    at = cum.groupBy(*by, "_q").agg(
        F.min(F.when(F.col("_cum") >= lo_rank, F.col("_v"))).alias("_a"),
        F.min(F.when(F.col("_cum") >= hi_rank, F.col("_v"))).alias("_b"),
        F.first("_pos").alias("_pos"),
    )
    found = F.col("_b").isNotNull() & (F.col("_a") > float("-inf"))
    exact = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_pos") - F.floor("_pos"))
    checked = F.when(found, exact).otherwise(F.raise_error(F.lit("quantile bracket missed its rank")).cast("double"))
    cols = [F.max(F.when(F.col("_q") == name, checked)).alias(name) for name in probs]
    return at.groupBy(*by).agg(*cols)


def group_medians(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Exact median of each column for very many small groups.

    Counts distinct values first, so repeated rows of a hot group collapse in the tasks that read them.
    """
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(list(by), list(cols), "_m", "_v")
    counts = long.where(F.col("_v").isNotNull()).groupBy(*by, "_m", "_v").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by, "_m")
    cum = counts.withColumns({"_cum": F.sum("_c").over(w.orderBy("_v")), "_n": F.sum("_c").over(w)})

    def at(rank: Column, name: str) -> Column:
        inside = (F.col("_m") == name) & (F.col("_cum") >= rank) & (F.col("_cum") - F.col("_c") < rank)
        return F.max(F.when(inside, F.col("_v")))

    lo, hi = F.floor((F.col("_n") - 1) / 2) + 1, F.floor(F.col("_n") / 2) + 1
    return cum.groupBy(*by).agg(*[((at(lo, c) + at(hi, c)) / 2.0).alias(c) for c in cols])
