"""Importance resampling towards a target text collection, by bit-sliced sums.

A feature is a run of words, a *bucket* the feature's crc32 modulo ``BUCKETS``. A bucket's *gain* is a
thousand times the logarithm of how much likelier it is in the target than in the documents, floored.
A document's weight is the mean of its features' gains.

The sum of gains is taken by bit slices. A document's bucket counts become planes: bit b of plane j is
bit j of the count of bucket b. Gains become signed planes in the same way, by magnitude, positive and
negative ones apart. Then sum(count * gain) = sum over i, j of 2^(i+j) times the bits that document
plane j shares with gain plane i, those of negative gains subtracted: AND, popcount and shifts of whole
machine words, exact in integers.

Texts are read once. Every task writes its documents' planes and, as its last row, the counts of its
buckets; those are summed in Spark, and only ``BUCKETS`` totals come to the driver. Gains go to the
tasks as planes, some tens of kilobytes whatever the corpus.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .registry import query, table
from .sharding import number_rows

BUCKETS = 10_000
#: Features that a worker remembers, and bytes of text or rows whose planes it makes at once.
REMEMBERED, TEXT_AT_ONCE, ROWS_AT_ONCE = 200_000, 1 << 20, 256
#: Planes that are ANDed at once; they fit a processor's cache.
PLANES_AT_ONCE = 512

_LOWERED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Maximal runs of digits, letters (A-Z lowered) and characters beyond ASCII."""
    return text.translate(_LOWERED).split()


def plane_bytes(buckets: int) -> int:
    """Bytes of one plane: whole 64-bit words."""
    return (buckets + 63) // 64 * 8


class _BucketOf(dict):
    """Bucket of a feature, computed when it is first asked for."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def features_of(words: list[bytes], shortest: int, longest: int) -> Iterator[bytes]:
    """All runs of ``shortest`` to ``longest`` consecutive words, joined by one space."""
    for n in range(shortest, longest + 1):
        if n == 1:
            yield from words
        else:
            yield from (b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))


def planes_of(owner: np.ndarray, bucket: np.ndarray, owners: int, buckets: int) -> list[bytes]:
    """Each owner's bucket counts as concatenated bit planes, the lowest bit first; none for no feature."""
    code, count = np.unique(owner * buckets + bucket, return_counts=True)
    row, column = code // buckets, code % buckets
    depth = np.zeros(owners, np.int64)
    np.maximum.at(depth, row, np.floor(np.log2(count)).astype(np.int64) + 1)
    first = np.cumsum(depth) - depth
    bits = np.zeros((int(depth.sum()), plane_bytes(buckets) * 8), np.uint8)
    for j in range(int(depth.max(initial=0))):
        held = np.flatnonzero(count >> j & 1)
        bits[first[row[held]] + j, column[held]] = 1
    packed = np.packbits(bits, axis=1, bitorder="little")
    return [packed[a : a + d].tobytes() for a, d in zip(first.tolist(), depth.tolist())]


def _documents(docs: DataFrame, key: str, text: str, shortest: int, longest: int, buckets: int) -> DataFrame:
    """key, n_words, n_features and planes of each row; and a last row a task with the counts of its buckets in ``totals``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of, totals = _BucketOf(buckets), np.zeros(buckets, np.int64)
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal totals
            owner = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
            bucket = np.concatenate([h[2] for h in held])
            totals += np.bincount(bucket, minlength=buckets)
            planes = planes_of(owner, bucket, len(held), buckets)
            columns = [
                pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()),
                pa.array([len(h[2]) for h in held], pa.int64()), pa.array(planes, pa.binary()), pa.nulls(len(held), pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        names, size = ["key", "n_words", "n_features", "planes", "totals"], 0
        for batch in batches:
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = value.as_buffer()
                words = words_of(raw.to_pybytes()) if raw is not None else []
                found = np.fromiter((bucket_of[f] for f in features_of(words, shortest, longest)), np.int64)
                held.append((k, len(words), found))
                size += len(raw) if raw is not None else 0
                if size >= TEXT_AT_ONCE or len(held) >= ROWS_AT_ONCE:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
        last = [pa.nulls(1, pa.int64())] * 3 + [pa.nulls(1, pa.binary()), pa.array([totals.tolist()], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(last, names=names)

    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    return given.mapInArrow(rows, "key long, n_words long, n_features long, planes binary, totals array<long>")


def bucket_totals(documents: DataFrame, buckets: int) -> list[int]:
    """Features in each bucket; ``buckets`` numbers come to the driver."""
    each = documents.where(F.col("totals").isNotNull()).select(F.posexplode("totals").alias("bucket", "n"))
    found = each.where("n > 0").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = [0] * buckets
    for row in found.collect():
        totals[row.bucket] = row.n
    return totals


def gains_of(raw: list[int], target: list[int]) -> np.ndarray:
    """Gain of each bucket: floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) in doubles."""
    s_all, t_all, b = float(sum(raw)), float(sum(target)), len(raw)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)))) for s, t in zip(raw, target)], np.int64)


def gain_planes(gains: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Signed planes of the gains' magnitudes as 64-bit words, and each one's power of two with its sign."""
    width, planes, factors = plane_bytes(len(gains)) * 8, [], []
    for sign in (1, -1):
        size = np.where(gains * sign > 0, gains * sign, 0)
        for i in range(int(size.max(initial=0)).bit_length()):
            bits = np.zeros(width, np.uint8)
            bits[: len(gains)] = size >> i & 1
            planes.append(np.packbits(bits, bitorder="little"))
            factors.append(sign << i)
    return np.array(planes, np.uint8).reshape(len(planes), width // 8).view(np.uint64), factors


def summed(planes: np.ndarray, exponents: np.ndarray, gains: np.ndarray, factors: list[int]) -> np.ndarray:
    """2^exponent * sum of gains over the bits of each plane."""
    out = np.zeros(len(planes), np.int64)
    for at in range(0, len(planes), PLANES_AT_ONCE):
        part = planes[at : at + PLANES_AT_ONCE]
        for g, factor in zip(gains, factors):
            out[at : at + PLANES_AT_ONCE] += factor * np.bitwise_count(part & g).sum(axis=1, dtype=np.int64)
    return out << exponents


def _weights(documents: DataFrame, gains: np.ndarray) -> DataFrame:
    """key, n_words, n_features and weight of each document row."""
    width = plane_bytes(len(gains))
    planes, factors = gain_planes(gains)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy(zero_copy_only=False)
            sums = np.zeros(len(n), np.int64)
            held = [v.as_buffer() for v in batch.column(3)]
            depth = np.array([len(h) // width for h in held], np.int64)
            for at in range(0, len(held), ROWS_AT_ONCE):
                d = depth[at : at + ROWS_AT_ONCE]
                flat = np.frombuffer(b"".join(held[at : at + ROWS_AT_ONCE]), np.uint64).reshape(-1, width // 8)
                exponent = np.arange(len(flat)) - np.repeat(np.cumsum(d) - d, d)
                np.add.at(sums, np.repeat(np.arange(at, at + len(d)), d), summed(flat, exponent, planes, factors))
            weight = pa.array(sums // np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], weight], names=["key", "n_words", "n_features", "weight"])

    given = documents.where(F.col("totals").isNull()).select("key", "n_words", "n_features", "planes")
    return given.mapInArrow(rows, "key long, n_words long, n_features long, weight long")


def noise(key: Column, seed: str) -> Column:
    """A thousand times a Gumbel variate, floored, from the first 32 bits of sha256 of the seed and the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: str = "2024", key: str = "doc_id", text: str = "text",
    target_text: str = "text", shortest: int = 1, longest: int = 1, buckets: int = BUCKETS,
) -> DataFrame:
    """key, n_features, weight, score and rank of every row of ``docs``.

    Of the N rows with at least ``least_words`` words, the floor(percent * N / 100) with the highest
    score are drawn; ``rank`` counts them from 1, ties to the smaller key, and is null for the others.
    Rows that repeat a key have the same noise and take neighbouring ranks; a null key sorts first. A
    null or empty text has no feature, weight 0, and is drawn only if ``least_words`` is 0. Without
    features in either table all gains still follow from the formula. Other columns are not read.
    """
    documents = materialize(_documents(docs, key, text, shortest, longest, buckets), "bucket-planes")
    wanted = materialize(_documents(target.select(F.lit(0).alias("_key"), target_text), "_key", target_text, shortest, longest, buckets).drop("planes"), "target-buckets")
    gains = gains_of(bucket_totals(documents, buckets), bucket_totals(wanted, buckets))
    weighed = _weights(documents, gains).withColumn("score", F.col("weight") + noise(F.col("key"), seed))
    scores = materialize(weighed.withColumn("eligible", F.col("n_words") >= least_words), "scores")

    # a row for each score: as many as the gains' range and the noise's allow, whatever the corpus
    by_score = scores.where("eligible").groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    running = by_score.select("score", (F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")).alias("above"), "n")
    draws = (scores.where("eligible").count() * percent) // 100
    cut = running.where(F.col("above") < draws).agg(F.min("score")).first()[0]
    in_play = F.col("eligible") & (F.col("score") >= F.lit(cut)) if cut is not None else F.lit(False)
    drawn = scores.where(in_play).withColumn("order", -F.col("score"))
    numbered = number_rows(drawn, ["order", "key"], "place")[0]
    rank = F.when(F.col("place") < draws, F.col("place") + 1).cast("long").alias("rank")
    columns = [F.col("key").alias(key), "n_features", "weight", "score"]
    return numbered.select(*columns, rank).unionByName(scores.where(~in_play).select(*columns, F.lit(None).cast("long").alias("rank")))


@query(
    "op11_importance_resampling",
    r"""
    WITH bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_table),
    d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
    b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
    f AS (SELECT id, unnest(ws) AS w FROM d),
    known AS (SELECT DISTINCT w, hex(encode(w)) AS x FROM (SELECT w FROM f UNION SELECT w FROM b)),
    coded AS (SELECT w, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(len(x) // 2), lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT))),
        lambda c, v: xor(c >> 8, crc_table[(xor(c, v) & 255) + 1]))) % 10000 AS bucket FROM known, bits),
    s AS (SELECT bucket, count(*) AS s FROM f JOIN coded USING (w) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS t FROM b JOIN coded USING (w) GROUP BY bucket),
    al AS (SELECT (SELECT count(*) FROM f) AS s_all, (SELECT count(*) FROM b) AS t_all),
    g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000)))) AS gain FROM s LEFT JOIN t USING (bucket), al),
    weights AS (SELECT id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM f JOIN coded USING (w) JOIN g USING (bucket) GROUP BY id),
    scored AS (SELECT doc_id, len(ws) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
        FROM d LEFT JOIN weights USING (id)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE words >= 20) OVER () AS eligible FROM scored)
    SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN words >= 20 AND place <= eligible * 10 // 100 THEN place END AS rank FROM ranked
    """,
)
def op11(spark, sf_dir):
    """All documents towards the texts of ``benchmark``: single words, a tenth drawn."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
