"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A code is cut into m segments of 16 bits. Two codes at distance below m (s + 1) agree in some segment
up to s bits, so looking up every segment value within s bits of the query's finds all of them. The
radius s grows by one a round, for the queries that need it: once the k-th verified distance is at
most m (s + 1) - 1, nothing unseen can be nearer or as near, and the query is done.

Codes of different lengths have no distance: each query is answered by the codes of its own length.

Codes are dealt into blocks of one length, each indexed by segment where it is searched; queries travel
in packs of one length, one row for each pack and block. Of a code that many rows share only the k + 1 smallest ids can be in
any answer, so the others are left out before anything moves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .registry import query, table

SEGMENT = 16
BLOCK_CODES, PACK_QUERIES = 16384, 1024
#: Queries looked up at once, so that the values within the radius fit in memory.
AT_ONCE = 128


def _segments(bits: int) -> int:
    """Segments of a code of ``bits`` bits."""
    return -(-bits // SEGMENT)


def sign_codes(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key, bits and code: one bit a dimension, set where it is at least zero, padded to whole segments.

    ``bits`` is the vector's own length. Null keys and null or empty vectors have no code and are left
    out; a null or not-a-number component has no bit.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(1))
            for dims in pc.unique(sizes).to_pylist():
                part = batch.filter(pc.equal(sizes, dims))
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                bits = np.zeros((part.num_rows, _segments(dims) * SEGMENT), np.uint8)
                with np.errstate(invalid="ignore"):
                    bits[:, :dims] = flat.reshape(part.num_rows, dims) >= 0
                codes = [row.tobytes() for row in np.packbits(bits, axis=1)]
                columns = [part.column(0), pa.array([dims] * part.num_rows, pa.int32()), pa.array(codes, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "bits", "code"])

    given = df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    return given.where(F.col("key").isNotNull() & (F.size("v") > 0)).mapInArrow(rows, "key long, bits int, code binary")


def _masks(radius: int) -> np.ndarray:
    """All 16-bit numbers with ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT), radius)], np.uint16)


class Index:
    """Segment tables of a block of codes."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        self.codes, self.ids = codes, ids
        self.tables = []
        for i in range(codes.shape[1]):
            order = np.argsort(codes[:, i], kind="stable")
            starts = np.searchsorted(codes[order, i], np.arange((1 << SEGMENT) + 1))
            self.tables.append((order, starts))

    def ring(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, distance) of the rows whose nearest segment lies at exactly ``radius``."""
        masks, found = _masks(radius), []
        for i, (order, starts) in enumerate(self.tables):
            values = (queries[:, i][:, None] ^ masks[None, :]).astype(np.int64)
            first, count = starts[values], starts[values + 1] - starts[values]
            q = np.repeat(np.arange(len(queries)), count.sum(axis=1))
            first, count = first.ravel(), count.ravel()
            hit = count > 0
            first, count = first[hit], count[hit]
            ends = np.cumsum(count)
            at = order[np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]
            near = np.bitwise_count(self.codes[at] ^ queries[q])
            # seen before at a smaller radius, or by an earlier segment
            new = np.flatnonzero((near.min(axis=1) == radius) & (near.argmin(axis=1) == i))
            found.append((q[new], at[new], near[new].sum(axis=1, dtype=np.int64)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _best(q: np.ndarray, d: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest (distance, id) of each query."""
    order = np.lexsort((ids, d, q))
    sorted_q = q[order]
    begins = np.searchsorted(sorted_q, sorted_q)
    return order[np.arange(len(order)) - begins < k]


def _search(radius: int, k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, None
        for batch in batches:
            for row in batch.to_pylist():
                segments = _segments(row["bits"])
                if (row["bits"], row["block"]) != last:  # rows of one block stand together
                    codes = np.frombuffer(b"".join(row["codes"]), np.uint16).reshape(-1, segments)
                    last, index = (row["bits"], row["block"]), Index(codes, np.array(row["ids"], np.int64))
                asked = np.frombuffer(b"".join(row["asked"]), np.uint16).reshape(-1, segments)
                asker, bound = np.array(row["askers"], np.int64), np.array(row["bounds"], np.int64)
                for at in range(0, len(asked), AT_ONCE):
                    part = slice(at, at + AT_ONCE)
                    q, r, d = index.ring(asked[part], radius)
                    ok = (d <= bound[part][q]) & (index.ids[r] != asker[part][q])
                    q, r, d = q[ok], r[ok], d[ok]
                    top = _best(q, d, index.ids[r], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asker[part][q[top]]), pa.array(index.ids[r[top]]), pa.array(d[top])], names=["query", "key", "distance"]
                    )

    return rows


def nearest_codes(codes: DataFrame, asks: Column, k: int = 10) -> DataFrame:
    """query, key, distance, rank (from 1): the k codes nearest to every code for which ``asks`` holds.

    Only codes of the same number of bits are compared. Ties go to the smaller key; a query's own key is
    not among its answers. With fewer than k others of its length, all are returned; with none, the query
    has no row. ``codes`` has key (unique whole numbers), bits and code; repeated rows count once.
    """
    if k < 1:
        raise ValueError("k must be positive")
    codes = materialize(codes.select("key", "bits", "code").distinct(), "codes")
    order = Window.partitionBy("bits", "code").orderBy("key")
    kept = codes.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1).drop("_n")
    kept = materialize(kept, "searched-codes")
    blocks = max(1, -(-kept.count() // BLOCK_CODES))
    # a rare length has as many, smaller blocks
    dealt = kept.groupBy("bits", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block"))
    packed = dealt.agg(F.collect_list(F.struct("key", "code")).alias("c"))  # as many as a block holds
    index = materialize(packed.select("bits", "block", F.col("c.code").alias("codes"), F.col("c.key").alias("ids")), "code-blocks")
    # a query and the bound on its k-th distance
    waiting = materialize(codes.where(asks).select(F.col("key").alias("query"), "bits", "code", F.col("bits").cast("long").alias("bound")), "queries")
    found = None
    done: list[DataFrame] = []
    radius = 0
    while not waiting.isEmpty():
        packs = max(1, -(-waiting.count() // PACK_QUERIES))
        pack = waiting.groupBy("bits", F.pmod(F.xxhash64("query"), F.lit(packs)).alias("pack")).agg(F.collect_list(F.struct("query", "code", "bound")).alias("q"))
        asked = pack.select(
            "bits", F.col("q.code").alias("asked"), F.col("q.query").alias("askers"), F.col("q.bound").alias("bounds"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        )
        rows = index.join(asked, ["bits", "block"]).select("bits", "block", "codes", "ids", "asked", "askers", "bounds")
        ring = rows.mapInArrow(_search(radius, k), "query long, key long, distance long")
        every = ring if found is None else ring.unionByName(found)
        rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "key"))
        best = materialize(every.withColumn("rank", rank).where(F.col("rank") <= k), "nearest")
        covered = F.ceil(F.col("bits") / SEGMENT) * (radius + 1) - 1
        kth = best.groupBy("query").agg(F.max(F.when(F.col("rank") == k, F.col("distance"))).alias("kth"))
        state = waiting.join(kth, "query", "left")
        sure = (F.coalesce("kth", F.col("bits") + 1) <= covered) | (covered >= F.col("bits"))
        state = materialize(state.withColumn("sure", sure), "query-state")
        open_ = state.where(~F.col("sure"))
        done.append(best.join(state.where("sure").select("query"), "query"))
        found = best.join(open_.select("query"), "query").drop("rank")
        waiting = open_.select("query", "bits", "code", F.least("bound", F.coalesce("kth", "bound")).alias("bound"))
        radius += 1
    out = None
    for part in done:
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = codes.sparkSession.createDataFrame([], "query long, key long, distance long, rank int")
    return out.select("query", "key", "distance", "rank")


@query(
    "op10_exact_topk",
    """
    WITH pairs AS (
        SELECT q.vec_id AS query, c.vec_id AS key,
            CAST(list_sum(list_transform(range(1, len(q.embedding) + 1),
                lambda i: CAST((q.embedding[i] >= 0) <> (c.embedding[i] >= 0) AS BIGINT))) AS BIGINT) AS distance
        FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id AND len(q.embedding) = len(c.embedding)
        WHERE q.vec_id % 20 = 0 AND len(q.embedding) > 0
    ),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY distance, key) AS INTEGER) AS rank FROM pairs)
    SELECT query, key, distance, rank FROM ranked WHERE rank <= 10
    """,
)
def op10(spark, sf_dir):
    """The ten nearest sign codes of every twentieth vector, out of all vectors of its length.

    A null or empty vector asks nothing and answers nothing.
    """
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_codes(sign_codes(vectors, "vec_id", "embedding"), F.col("key") % 20 == 0, 10)
