"""Exact similarity join of shingle sets by a token-group matrix.

A text's set holds the hashes of its runs of ``width`` words. Texts with the same set are one *class*.
Two classes are linked when 100 * intersection >= percent * union, and the result names for every text
the smallest key reachable over links. No step leaves anything to chance:

1. *Groups.* Classes with the same two minwise tokens form a group; larger ones than ``MEMBERS`` are
   split. Which classes share a group decides only how well the bounds below work.
2. *Order.* All tokens are counted, and every set is ordered from rare to frequent tokens (by powers of
   two; ties by hash). Linked sets share one of the first n - ceil(n * percent / 100) + 1 tokens of
   both, the *prefix*.
3. *Matrix.* A group is a column: the union of its members' prefixes, and, for the bounds, the union of
   their whole sets as a bitmap. Rows with one group are left out, so what is kept are (token, group)
   marks of tokens that may connect. Groups that share no row hold no linked classes.
4. *Bounds.* A bit of a query's bitmap that a group's union lacks is a token that no member has. Only
   when the overlap left by that could reach the threshold with a member of a fitting size is the group
   opened; its members are bounded in the same way, by their own bitmaps, in both directions.
5. *Confirmation* on whole sets, from the texts, of what the bounds leave.

A component is known by any links that connect it, so a group first meets only its first member, and a
column only the first group of the row that it shares most rows with. Groups and rows that by then
lie in one component are done; of the rest, those outside a row's main component query the others:
first each class meets its best partner in a few rows, then all that are left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import attach
from ..session import materialize
from .neardup import _mix, components, having
from .registry import query, table

#: Classes of a group, and bits of the smallest and largest bitmap.
MEMBERS, LEAST_BITS, MOST_BITS = 64, 256, 1 << 15
#: A token counts as frequent from so many texts, and at most so many are told to the tasks (9 bytes each).
FREQUENT, MOST_FREQUENT = 8, 1 << 20
#: Tokens that a task sorts at once, and tokens or marks of a bucket.
TOKENS_AT_ONCE, BUCKET_TOKENS = 1 << 21, 500_000
#: Bits of a token in the counts (equal ones are ordered alike) and in the matrix (equal ones are one row), and of a group's number.
COUNTED_BITS, ROW_BITS, GROUP_BITS = 40, 48, 40
#: Groups of one block of a row; rounds in which classes look for their best partner, and rows where a group asks in these.
BLOCK, BEST_ROUNDS, BEST_ROWS = 512, 2, 4
#: Bytes of text that are hashed at once.
TEXT_AT_ONCE = 1 << 20
_U = np.uint64
_SALTS = (_U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB))



def _spread(n: int) -> np.ndarray:
    """The first n numbers of a fixed pseudo-random sequence."""
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTE = _spread(256)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]  # A-Z count as a-z
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def _hashed_words(data: np.ndarray, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word: its bytes' numbers as digits of a number modulo 2^64, then spread."""
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)], dtype=np.uint64)])
    return start, _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def sets_of(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the runs of ``width`` words of each text; all words as one if there are fewer."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    factors = _spread(width)
    up = down = np.zeros(0, np.uint64)
    at = 0
    while at < len(texts):
        last = max(at + 1, int(np.searchsorted(offsets, offsets[at] + TEXT_AT_ONCE, "right")) - 1)
        last = min(last, len(texts))
        # a space before each text keeps its words apart from the one before
        lengths = np.diff(offsets[at : last + 1])
        begins = np.cumsum(lengths + 1) - lengths
        part = np.insert(data[offsets[at] : offsets[last]], offsets[at:last] - offsets[at], 0x20)
        if len(part) > len(up):
            up, down = _powers(_BASE, len(part)), _powers(_INVERSE, len(part))
        start, words = _hashed_words(part, up, down)
        runs = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            runs += words[k : k + len(runs)] * factors[k]
        runs = _mix(runs)
        first = np.searchsorted(start, begins)
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(words)]):
            if b - a >= width:
                found = np.sort(runs[a : b - width + 1])
                yield found[np.flatnonzero(np.diff(found, prepend=~found[:1]))]
            elif b > a:
                yield _mix((words[a:b] * factors[: b - a]).sum(keepdims=True, dtype=np.uint64) + _U(b - a))
            else:
                yield np.zeros(0, np.uint64)
        at = last


def needed(n: np.ndarray | int, percent: int):
    """Tokens that a set of n must share with a linked one, at least."""
    return -(-percent * n // 100)


def group_key(found: np.ndarray) -> int:
    """Two minwise tokens as one number."""
    a, b = (int(_mix(found ^ s).min()) for s in _SALTS)
    return ((a * 31 + b) & 0xFFFFFFFFFFFFFFFF) - (1 << 63)


def bitmap(found: np.ndarray) -> np.ndarray:
    """Bit (token modulo size) for each token; the size is a power of two of about twice the set."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << int(2 * len(found) - 1).bit_length()))
    bits = np.zeros(size, np.uint8)
    bits[(found & _U(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap at a smaller power of two: each bit stands for all tokens of that remainder."""
    return np.bitwise_or.reduce(bits.reshape(-1, width), axis=0) if len(bits) > width else bits


def lacking(one: np.ndarray, other: np.ndarray) -> int:
    """Tokens of one set that the other surely lacks, by their bitmaps."""
    width = min(len(one), len(other))
    return int(np.bitwise_count(folded(one, width) & ~folded(other, width)).sum())


def may_link(n: int, m: int, overlap: int, percent: int) -> bool:
    """Whether sets of n and m tokens that share at most ``overlap`` can reach the threshold."""
    return 100 * min(n, m) >= percent * max(n, m) and (100 + percent) * overlap >= percent * (n + m)


def pack(numbers: np.ndarray, width: int) -> bytes:
    """Numbers as ``width`` planes of bytes, compressed; small differences leave empty planes."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _sets(docs: DataFrame, key: str, text: str, width: int, made, schema: str, names: list[str]) -> DataFrame:
    """``made(key, sorted tokens)`` for each row, as a row or None."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            out = []
            for k, found in zip(batch.column(0).to_pylist(), sets_of(batch.column(1), width), strict=True):
                row = made(k, found, seen)
                if row is not None:
                    out.append(row)
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names).cast(target)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names).cast(target)

    kinds = {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
    target = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])
    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    return given.mapInArrow(rows, schema)


def _set_id(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _buckets(total: int) -> int:
    return max(1, -(-total // BUCKET_TOKENS))


def _bucket_runs(values: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted values below 2^bits, as slices."""
    drop = max(0, bits - 32)
    bucket = ((values >> _U(drop)) * _U(buckets)) >> _U(bits - drop)
    edges = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - _U(1) if len(bucket) else bucket))
    for a, b in zip(edges, [*edges[1:], len(values)]):
        yield int(bucket[a]), slice(a, b)


def frequent_tokens(docs: DataFrame, text: str, width: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted counted parts of the frequent tokens of all texts, and the power of two of each one's count.

    All tokens are counted, packed to some two bytes each. Should more than ``MOST_FREQUENT`` be frequent,
    the least frequent are left out; the order stays valid whatever is told.
    """
    buckets, drop = _buckets(total), _U(64 - COUNTED_BITS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            out = [
                (b, pack(np.diff(values[s], prepend=_U(0)), 6), pack(times[s], 4)) for b, s in _bucket_runs(values, COUNTED_BITS, buckets)
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["bucket", "tokens", "times"])

        for batch in batches:
            for found in sets_of(batch.column(0), width):
                held.append(found >> drop)
                size += len(found)
                if size >= TOKENS_AT_ONCE:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    def heavy(rows: pa.Table) -> pa.Table:
        values = np.concatenate([np.cumsum(unpack(v.as_py(), 6)) for v in rows["tokens"]])
        times = np.concatenate([unpack(v.as_py(), 4) for v in rows["times"]]).astype(np.int64)
        order = np.argsort(values, kind="stable")
        values, times = values[order], times[order]
        first = np.flatnonzero(np.diff(values, prepend=~values[:1]))
        sums = np.add.reduceat(times, first)
        many = np.flatnonzero(sums >= FREQUENT)
        level = np.log2(sums[many] / FREQUENT).astype(np.int64) + 1
        return pa.table([pa.array(values[first][many].astype(np.int64)), pa.array(level)], names=["token", "level"])

    given = docs.where(F.col(text).isNotNull()).select(F.col(text).cast("binary").alias("text"))
    packed = given.mapInArrow(counted, "bucket long, tokens binary, times binary")
    found = materialize(packed.groupBy("bucket").applyInArrow(heavy, "token long, level long"), "frequent-tokens")
    kept, least = 0, 1
    for level, n in sorted(found.groupBy("level").count().collect(), reverse=True):  # at most 64 rows
        kept += n
        if kept > MOST_FREQUENT:
            least = level + 1
            break
    told = found.where(F.col("level") >= least).toArrow()
    tokens, levels = told["token"].to_numpy().astype(np.uint64), told["level"].to_numpy().astype(np.uint8)
    order = np.argsort(tokens)
    return tokens[order], levels[order]


def prefix(found: np.ndarray, percent: int, frequent: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The tokens of a set of which it shares one with every linked set, rare ones first."""
    length = len(found) - needed(len(found), percent) + 1
    if not len(frequent):
        return found[:length]
    part = found >> _U(64 - COUNTED_BITS)
    at = np.minimum(np.searchsorted(frequent, part), len(frequent) - 1)
    level = np.where(frequent[at] == part, levels[at], 0)
    return found[np.argsort(level, kind="stable")[:length]]


def _groups(payload: DataFrame) -> DataFrame:
    """One row a group: its first member, the others, and the union of their prefixes."""

    names = ["group", "rep_n", "rep_map", "sets", "rest_n", "rest_maps", "tokens"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, out = None, {}, []

        def closed() -> tuple:
            order = sorted(members)
            kept = [members[s] for s in order]
            tokens = np.unique(np.concatenate([np.frombuffer(m[1], np.uint64) >> _U(64 - ROW_BITS) for m in kept]))
            rest = kept[1:]
            return now, kept[0][0], kept[0][2], order, [m[0] for m in rest], [m[2] for m in rest], tokens.tobytes()

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            for group, set_id, n, first, bits in zip(*(c.to_pylist() for c in batch.columns)):
                if group != now:
                    if members:
                        out.append(closed())
                        if len(out) >= 1000:
                            yield batch_of()
                            out = []
                    now, members = group, {}
                members[set_id] = (n, first, bits)  # a class comes at most once a task
        if members:
            out.append(closed())
        if out:
            yield batch_of()

    given = payload.select("group", "set_id", "n", "prefix", "bits").repartition("group").sortWithinPartitions("group")
    return given.mapInArrow(rows, "group long, rep_n long, rep_map binary, sets array<binary>, rest_n array<long>, rest_maps array<binary>, tokens binary")


def _matrix(groups: DataFrame, total: int) -> DataFrame:
    """(token, group) marks of the rows that hold at least two groups."""
    buckets = _buckets(total)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners, size = [], [], 0

        def flush() -> pa.RecordBatch:
            token, owner = np.concatenate(tokens), np.concatenate(owners)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            out = [
                (b, pack(np.diff(token[s], prepend=_U(0)), 6), pack(owner[s], 5)) for b, s in _bucket_runs(token, ROW_BITS, buckets)
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["bucket", "tokens", "groups"])

        for batch in batches:
            for group, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(raw.as_buffer(), np.uint64)
                tokens.append(found)
                owners.append(np.full(len(found), group, np.uint64))
                size += len(found)
                if size >= TOKENS_AT_ONCE:
                    yield flush()
                    tokens, owners, size = [], [], 0
        if size:
            yield flush()

    def shared(rows: pa.Table) -> pa.Table:
        token = np.concatenate([np.cumsum(unpack(v.as_py(), 6)) for v in rows["tokens"]])
        owner = np.concatenate([unpack(v.as_py(), 5) for v in rows["groups"]])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        same = np.concatenate([token[1:] == token[:-1], [False]])
        many = same | np.concatenate([[False], same[:-1]])
        return pa.table([pa.array(token[many].astype(np.int64)), pa.array(owner[many].astype(np.int64))], names=["token", "group"])

    packed = groups.select("group", "tokens").mapInArrow(marks, "bucket long, tokens binary, groups binary")
    return packed.groupBy("bucket").applyInArrow(shared, "token long, group long")


def _confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold. Texts move compressed."""

    def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([zstandard.compress(v.as_buffer(), 3) for v in batch.column(1)], pa.binary())], names=["key", "text"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, None
        one = lambda t: next(sets_of(pa.array([zstandard.decompress(t.as_buffer())], pa.binary()), width))
        for batch in batches:
            kept = []
            for i, (b, ta, tb) in enumerate(zip(*(batch.column(c) for c in (1, 2, 3)), strict=True)):
                if b.as_py() != last:
                    last, of_last = b.as_py(), one(tb)
                mine = one(ta)
                same = len(np.intersect1d(mine, of_last, assume_unique=True))
                if 100 * same >= percent * (len(mine) + len(of_last) - same):
                    kept.append(i)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int32()))

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text")).where("text is not null")
    texts = having(given, wanted, "key", "left_semi").mapInArrow(squeezed, "key long, text binary")
    texts = materialize(texts, "texts")
    twice = texts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():  # rows that repeat a key have the same set
        texts = texts.dropDuplicates(["key"])
    left = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(rows, "a long, b long")


def _within(groups: DataFrame, percent: int) -> DataFrame:
    """(set_a, set_b) of each group's first member and the others that may be linked with it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for n, bits, sets, rest_n, rest in zip(*(c.to_pylist() for c in batch.columns)):
                one = np.frombuffer(bits, np.uint8)
                for set_id, m, other in zip(sets[1:], rest_n, rest):
                    other = np.frombuffer(other, np.uint8)
                    if may_link(n, m, min(n - lacking(one, other), m - lacking(other, one)), percent):
                        a.append(sets[0])
                        b.append(set_id)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["set_a", "set_b"])

    several = groups.where(F.size("sets") > 1).select("rep_n", "rep_map", "sets", "rest_n", "rest_maps")
    return several.mapInArrow(rows, "set_a binary, set_b binary")


def _first_met(groups: DataFrame, matrix: DataFrame, percent: int) -> DataFrame:
    """(set_a, set_b) of first members: each group's, and that of the first group of the rows it shares most."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (n, one, m, other) in enumerate(zip(*(c.to_pylist() for c in batch.columns[2:]))):
                one, other = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
                if may_link(n, m, min(n - lacking(one, other), m - lacking(other, one)), percent):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int32()))

    first = matrix.groupBy("token").agg(F.min("group").alias("hub"))
    met = matrix.join(first, "token").where("group <> hub").groupBy("group", "hub").agg(F.count(F.lit(1)).alias("c"))
    best = met.groupBy("group").agg(F.max(F.struct("c", "hub")).alias("m")).select("group", F.col("m.hub").alias("hub"))
    rep = groups.select("group", F.element_at("sets", 1).alias("set"), F.col("rep_n").alias("n"), F.col("rep_map").alias("map"))
    a = best.join(rep.toDF("group", "set_a", "n_a", "map_a"), "group")
    both = a.join(rep.toDF("hub", "set_b", "n_b", "map_b"), "hub")
    return both.select("set_a", "set_b", "n_a", "map_a", "n_b", "map_b").mapInArrow(rows, "set_a binary, set_b binary")


def _asked(matrix: DataFrame, state: DataFrame, rows_each: int | None) -> DataFrame:
    """(query, group): in each row with several components, groups outside the main one ask the others.

    A row of many groups is dealt into blocks, in all of which an asking group asks. With ``rows_each`` a
    group asks only in so many of its rows, the first by hash.
    """
    marks = matrix.join(state.select("group", "lot", "low", "high"), "group")
    lots = marks.groupBy("token", "lot").agg(F.count(F.lit(1)).alias("c"))
    live = lots.groupBy("token").agg(F.max(F.struct("c", "lot")).alias("main"), F.count(F.lit(1)).alias("lots"), F.sum("c").alias("size"))
    live = live.where("lots > 1").select("token", F.col("main.lot").alias("main"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = materialize(marks.join(live, "token"), "live-rows")
    home = F.pmod(F.xxhash64("group"), F.col("blocks")).cast("int")
    others = rows.select("token", home.alias("block"), "group", "lot", "low", "high")
    asking = rows.where("lot <> main")
    if rows_each is not None:
        first = Window.partitionBy("group").orderBy(F.xxhash64("token"), "token")
        asking = asking.withColumn("place", F.row_number().over(first)).where(F.col("place") <= rows_each)
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asking = asking.select("token", every.alias("block"), F.col("group").alias("query"), F.col("lot").alias("q_lot"), F.col("low").alias("q_low"), F.col("high").alias("q_high"))
    pairs = asking.join(others, ["token", "block"]).where("q_lot <> lot")
    # sizes of linked sets differ by the threshold at most; members are compared exactly later
    pairs = pairs.where((F.col("q_low") <= F.col("high")) & (F.col("low") <= F.col("q_high")))
    if rows_each is None:  # one direction is enough
        pairs = pairs.select(F.least("query", "group").alias("query"), F.greatest("query", "group").alias("group"))
    return pairs.select("query", "group").distinct()


def _lacks(one: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that a set surely has more than each of others, and the others more than it."""
    width = min(len(one), many.shape[1])
    one = folded(one, width)
    if many.shape[1] > width:
        many = np.bitwise_or.reduce(many.reshape(len(many), -1, width), axis=1)
    return np.bitwise_count(one & ~many).sum(axis=1, dtype=np.int64), np.bitwise_count(many & ~one).sum(axis=1, dtype=np.int64)


def _opened(pairs: DataFrame, columns: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """(a, b) of classes in two components that the bounds let through.

    With ``best_only`` a class of a query group names its best partner in each opened group, and of
    these the best one stays.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            for n1, maps1, key1, lab1, n2, maps2, key2, lab2 in zip(*(c.to_pylist() for c in batch.columns)):
                maps2 = [np.frombuffer(m, np.uint8) for m in maps2]
                width = min(map(len, maps2))
                many = np.array([folded(m, width) for m in maps2])
                union = np.bitwise_or.reduce(many)
                m, labels, keys, least, most = np.array(n2), np.array(lab2), np.array(key2), min(n2), max(n2)
                for n, bits, k, label in zip(n1, maps1, key1, lab1):
                    if 100 * most < percent * n or 100 * n < percent * least:
                        continue
                    one = np.frombuffer(bits, np.uint8)
                    if len(n2) > 1 and (100 + percent) * (n - lacking(one, union)) < percent * (n + max(least, needed(n, percent))):
                        continue  # no member can reach the threshold
                    more, less = _lacks(one, many)
                    overlap = np.minimum(n - more, m - less)
                    fits = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & ((100 + percent) * overlap >= percent * (n + m))
                    at = np.flatnonzero(fits & (labels != label))
                    if len(at):
                        score = overlap[at] / (n + m[at] - overlap[at])
                        if best_only:
                            at, score = at[[np.argmax(score)]], score.max(keepdims=True)
                        out.append((np.full(len(at), k), keys[at], score))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query", "other", "score"])

    parts = ["ns", "maps", "classes", "labels"]
    one = columns.select(F.col("group").alias("query"), *[F.col(p).alias(f"q_{p}") for p in parts])
    both = pairs.join(one, "query").join(columns.select("group", *parts), "group")
    found = both.select(*[f"q_{p}" for p in parts], *parts).mapInArrow(rows, "query long, other long, score double")
    if best_only:
        found = found.groupBy("query").agg(F.max(F.struct("score", "other")).alias("m")).select("query", F.col("m.other").alias("other"))
    return found.select(F.least("query", "other").alias("a"), F.greatest("query", "other").alias("b")).distinct()


def similarity_components(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles and component_id of each row of ``docs``.

    ``key`` must be a whole number. A-Z is lowered, words end at ASCII white space; a text with fewer than
    ``width`` words is one run, and a null or empty text or one without words has an empty set and is
    linked with nothing. Rows with a null key are linked with nothing and have no component. Rows that
    repeat a key share its component; if their texts have different sets, all are judged by the smallest
    text. Other columns of ``docs`` are not read. Runs several jobs.
    """
    found = _sets(
        docs, key, text, width, lambda k, s, seen: (k, len(s), _set_id(s) if len(s) else None, group_key(s) if len(s) else None),
        "key long, n_shingles long, set_id binary, group_key long", ["key", "n_shingles", "set_id", "group_key"],
    )
    features = materialize(found, "sets")
    whole = features.where(F.col("key").isNotNull() & F.col("set_id").isNotNull())
    odd = whole.groupBy("key").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low <> high")
    if not odd.isEmpty():  # a key must name one set
        one = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias(key)).agg(F.min(text).alias(text))
        judged = similarity_components(one, width, percent, key, text)
        rows = docs.select(F.col(key).cast("long").alias(key)).join(judged, key, "left")
        return rows.withColumn("n_shingles", F.coalesce("n_shingles", F.lit(0).cast("long")))
    classes = materialize(whole.groupBy("set_id", "group_key").agg(F.min("key").alias("class"), F.first("n_shingles").alias("n")), "classes")
    total = features.agg(F.sum("n_shingles")).first()[0] or 0
    named = docs.where(F.col(key).isNotNull())

    frequent, levels = frequent_tokens(named, text, width, total)

    def payload(k, s, seen):
        if not len(s):
            return None
        set_id = _set_id(s)
        if set_id in seen:
            return None
        seen.add(set_id)
        return set_id, len(s), group_key(s), prefix(s, percent, frequent, levels).tobytes(), bitmap(s).tobytes()

    rows = _sets(
        named, key, text, width, payload, "set_id binary, n long, group_key long, prefix binary, bits binary", ["set_id", "n", "group_key", "prefix", "bits"]
    )
    crowded = classes.groupBy("group_key").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("parts")).where("parts > 1")
    rows = attach(rows, crowded, ["group_key"])
    part = F.coalesce(F.pmod(F.xxhash64("set_id"), F.col("parts")), F.lit(0))
    number = F.pmod(F.xxhash64("group_key", part), F.lit(1 << GROUP_BITS))
    groups = materialize(_groups(rows.withColumn("group", number)), "groups")
    marks = groups.agg(F.sum(F.octet_length("tokens") / 8)).first()[0] or 0
    matrix = materialize(_matrix(groups, int(marks)), "matrix")

    by_set = classes.select("set_id", "class")
    sets = groups.select("group", F.posexplode("sets").alias("at", "set_id"))
    connected = matrix.select("group").distinct().withColumn("marked", F.lit(True))
    members = sets.join(by_set, "set_id").join(connected, "group", "left").select("group", "at", "class", "marked")
    several = groups.where(F.size("sets") > 1).select("group").withColumn("several", F.lit(True))
    members = members.join(several, "group", "left").where("marked or several").select("group", "at", "class")
    members = materialize(members, "members")
    labels: DataFrame | None = None

    def add(pairs: DataFrame) -> None:
        """Confirm pairs and merge their components."""
        nonlocal labels
        sure = materialize(_confirmed(materialize(pairs, "candidates"), docs, key, text, width, percent).coalesce(8), "confirmed")
        if sure.isEmpty():
            return
        known = [] if labels is None else [labels.select(F.col("key").alias("a"), F.col("label").alias("b"))]
        labels = components(reduce(DataFrame.union, [sure, *known]))

    stars = _within(groups, percent).union(_first_met(groups, matrix, percent)).distinct()
    stars = stars.join(by_set.toDF("set_a", "x"), "set_a").join(by_set.toDF("set_b", "y"), "set_b")
    add(stars.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())

    sizes = groups.select("group", F.concat(F.array("rep_n"), "rest_n").alias("ns"), F.concat(F.array("rep_map"), "rest_maps").alias("maps"))
    ranges = groups.select("group", F.array_min(F.concat(F.array("rep_n"), "rest_n")).alias("low"), F.array_max(F.concat(F.array("rep_n"), "rest_n")).alias("high"))
    for best_only in [True] * BEST_ROUNDS + [False]:
        known = members.withColumn("label", F.col("class")) if labels is None else members.join(labels.withColumnRenamed("key", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
        listed = F.sort_array(F.collect_list(F.struct("at", "class", "label")))  # the members of a group
        state = known.groupBy("group").agg(listed.alias("m"), F.min("label").alias("first"), F.max("label").alias("last"))
        mixed = F.col("first") != F.col("last")
        # a group in one component stands for it; others stand for themselves
        lot = F.struct(mixed.alias("mixed"), F.when(mixed, F.col("group")).otherwise(F.col("first")).alias("id"))
        state = state.select("group", lot.alias("lot"), F.col("m.class").alias("classes"), F.col("m.label").alias("labels"))
        state = materialize(state.join(ranges, "group").withColumn("low", F.ceil(F.col("low") * percent / 100)), "state")
        alone = state.where("lot.mixed").select(F.col("group").alias("query"), "group")
        pairs = materialize(_asked(matrix, state, BEST_ROWS if best_only else None).union(alone), "asked")
        if pairs.isEmpty():
            break
        columns = sizes.join(state.select("group", "classes", "labels"), "group")
        used = pairs.select(F.explode(F.array("query", "group")).alias("group")).distinct()
        columns = materialize(columns.join(used, "group", "left_semi"), "columns")
        add(_opened(pairs, columns, percent, best_only))

    joined = features.select("key", "n_shingles", "set_id").join(by_set, "set_id", "left")
    if labels is not None:
        joined = joined.join(labels.select(F.col("key").alias("class"), "label"), "class", "left")
    else:
        joined = joined.withColumn("label", F.lit(None).cast("long"))
    component = F.when(F.col("key").isNotNull(), F.coalesce("label", "class", "key"))
    return joined.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"))


@query(
    "op13_ngram_jaccard_join",
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS ws
        FROM documents
    ),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s
        FROM d
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
    ),
    reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
    """,
)
def op13(spark, sf_dir):
    """All documents by shared five-word runs at 80 percent."""
    return similarity_components(table(spark, sf_dir, "documents"), width=5, percent=80)
