"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered 0..N-1 in the order of their key. A Feistel network permutes the smallest domain
of 4**h numbers that holds N, and a number that falls outside 0..N-1 is permuted again until it is
inside (cycle walking), so the result is a permutation of 0..N-1. A row's shard is its new number
modulo the number of shards, its slot the quotient: shard sizes differ by at most one, slots have no
gaps, and both can be computed from a row number and N alone, without the table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .registry import query, table, without

ROUNDS = 4
_ODD = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1
_WORKING = ("_tie", "_at", "_range", "_size", "_start", "_place", "_row")


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """One 64-bit key a round, by a multiplicative walk from the seed."""
    keys, x = [], seed & _WORD
    for _ in range(rounds):
        x = (x * 6364136223846793005 + 1442695040888963407) & _WORD
        keys.append(x)
    return keys


def half_bits(n: int) -> int:
    """Bits of each half of the smallest balanced domain with at least n numbers."""
    return max(1, -(-(max(n, 2) - 1).bit_length() // 2))


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The place of each of ``numbers`` (all in 0..n-1) in the shuffled order."""
    h = half_bits(n)
    mask, shift, keys = np.uint64((1 << h) - 1), np.uint64(h), [np.uint64(k) for k in round_keys(seed)]
    drop, odd = np.uint64(64 - h), np.uint64(_ODD)

    def network(x):
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (((right ^ k) * odd) >> drop)
        return (left << shift) | right

    out = network(numbers.astype(np.uint64))
    outside = np.flatnonzero(out >= n)
    while outside.size:
        out[outside] = network(out[outside])
        outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """Gapless numbers from 0 in the order of ``order`` (nulls first), and the number of rows.

    Rows are dealt into ranges, sorted there and written once. The ranges' sizes, one small row for
    each, give where a range starts. No task sees more than a range, and rows that are equal in all of
    ``order`` may lie in several ranges.
    """
    tie = df.withColumn("_tie", F.monotonically_increasing_id())
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = [*order, "_tie"]
    ranged = tie.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
    written = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    sizes = written.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count(F.lit(1)).alias("_size"))
    # one row for each range, at most the number of shuffle partitions
    starts = sizes.withColumn("_start", F.sum("_size").over(Window.orderBy("_range")) - F.col("_size"))
    starts = materialize(starts.coalesce(1), "range-starts")
    n = starts.agg(F.sum("_size")).first()[0] or 0
    joined = written.withColumn("_range", F.shiftright("_at", 33)).join(F.broadcast(starts), "_range")
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn(name, F.col("_start") + within).drop("_range", "_at", "_size", "_start"), n


def place(number: Column, n: int, seed: int) -> Column:
    """Shuffled place of a row number."""

    @F.pandas_udf("long")
    def moved(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), n, seed))

    return moved(number)


def shard(df: DataFrame, order: Sequence[str], shards: int, seed: int = 42) -> DataFrame:
    """``df`` with ``shard`` (0..shards-1) and ``slot`` (gapless from 0 in each shard).

    The result depends on the values in ``order``, the seed and the number of rows, not on files or
    partitions. Null keys sort first; rows equal in all of ``order`` take neighbouring numbers, and
    which of them takes which depends on the layout. Keep ``df`` narrow: all its columns are shuffled
    once. Other columns named ``shard``, ``slot`` or as one of ``_WORKING`` are replaced or left out. An
    empty table stays empty.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    numbered, n = number_rows(without(df, ["shard", "slot", *_WORKING], order), order, "_row")
    placed = numbered.withColumn("_place", place(F.col("_row"), n, seed))
    return placed.withColumns(
        {"shard": F.pmod("_place", F.lit(shards)).cast("int"), "slot": F.floor(F.col("_place") / shards).cast("long")}
    ).drop("_place", "_row")


def locate(number: int, n: int, shards: int, seed: int = 42) -> tuple[int, int]:
    """Shard and slot of one row number, computed without the table."""
    at = int(permute(np.array([number]), n, seed)[0])
    return at % shards, at // shards


@query("op4_sharding")
def op4(spark, sf_dir):
    """All documents over 16 shards whose counts differ by at most one. A null text has no bytes: size 1, crc 0."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return shard(docs, ["doc_id", "size", "text_crc32"], 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
