"""Near-duplicates by a chosen-path set similarity join, confirmed on whole shingle sets.

A text's set holds the hashes of its runs of ``width`` words. Texts with the same set are one *class*,
stood for by its smallest key; only classes are compared. Two classes are linked when the shared part
of their union reaches the threshold, and documents reachable over links form a component.

Candidates come from independent trees. A class carries ``COORDINATES`` minwise tokens. Every node of
a tree chooses ``CHOICES`` coordinates by a hash of its path, and a class descends into the child
named by the coordinate and its own token there. Classes that are alike in all but few shingles share
most tokens and stay together; others part. With two choices a pair at similarity s survives a level
when either child keeps it, so the chance p to stay together at any depth solves
p = 1 - (1 - s p)^2: at least 0.96 for s = 0.85 and 0.93 for s = 0.8 in each tree, and missing a pair
takes all trees. All trees use the same tokens, so they also fail together when these agree less often
than the sets; ``trees_for`` counts that in and takes as many trees as keep the chance to miss a pair at
the threshold to ``MISSED``. A node of one class is dropped at once.

A node need not name all pairs: a component is known by any links that connect it. So

1. every class is confirmed against one pivot, the smallest class of a node, of which it shares the
   most nodes;
2. nodes whose classes are all connected by now are done, as are pairs within a component;
3. of the rest, small nodes are compared exhaustively: first each class with its best partner in
   another component, then all pairs that still lie in two components, then those of nodes that have
   become small by it, until there is none. A node's largest component is split into blocks, and only
   classes outside it are compared with every block;
4. where that would take more than ``NODE_WORK`` comparisons, the node branches on, and all starts
   again for its children.

Comparison means estimating the similarity by a sketch that keeps the smallest shingle of each of
``BINS`` ranges; it is nearly the whole set of a short text. Pairs within ``SIGMAS`` standard deviations
below the threshold are confirmed on whole sets, recomputed from the texts. What can be lost is a pair
that no tree keeps together or that the estimate misses by more than that.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import BROADCAST_ROWS
from ..session import in_small_batches, materialize
from .registry import query, table
from .worker import only

COORDINATES, CHOICES = 128, 2
#: Chance that no tree keeps a pair at the threshold together; trees that a caller must ask for if it takes more.
MISSED, MANY_TREES = 0.001, 64
#: Ranges of the sketch; a power of two.
BINS = 512
#: Nodes in which a class looks for its best partner, before all pairs are looked at.
BEST_NODES = 2
#: Levels of the first descent, and of each later one.
DEPTH, STEP = 4, 2
#: Classes in a block, and comparisons above which a node branches on.
BLOCK, NODE_WORK = 512, 1 << 23
MAX_DEPTH = 64
SIGMAS = 3.5
REMEMBERED = 100_000

_U = np.uint64
_MULTIPLIERS = (np.arange(1, COORDINATES + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) >> _U(32)).astype(np.uint32) | np.uint32(1)
_ADDENDS = (np.arange(1, COORDINATES + 1, dtype=np.uint64) * _U(0xC2B2AE3D27D4EB4F) >> _U(32)).astype(np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words(dict):
    """Hash of a word, computed when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: bytes, width: int, words: _Words) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; all words as one if there are fewer."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - width + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(width, len(h))):
        out = _mix(out * _U(31) + h[i : i + n])
    return np.unique(out)


def minwise(found: np.ndarray) -> np.ndarray:
    """``COORDINATES`` tokens of a set: the upper half of the smallest value of each of as many permutations."""
    x = (found >> _U(32)).astype(np.uint32)
    best = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        part = x[at : at + 2048]
        best = np.minimum(best, (_MULTIPLIERS[:, None] * part[None, :] + _ADDENDS[:, None]).min(axis=1))
    return (best >> np.uint32(16)).astype(np.uint16)


def sketch(found: np.ndarray) -> bytes:
    """One byte for each range of hashes: 0 without a shingle, else from the smallest one (1 to 255)."""
    shift = _U(64 - (BINS - 1).bit_length())
    ranges = found >> shift
    first = np.flatnonzero(np.diff(ranges, prepend=~ranges[:1]) != 0)
    out = np.zeros(BINS, np.uint8)
    out[ranges[first].astype(np.int64)] = (found[first] & _U(0xFFFF)) % _U(255) + _U(1)
    return out.tobytes()


def alike(one: np.ndarray, many: np.ndarray, size: int, sizes: np.ndarray, goal: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of a sketch to others, and whether it may reach ``goal``.

    Of a union of u shingles the m ranges in use hold m, drawn without replacement.
    """
    either = (many | one).astype(bool).sum(axis=1)
    share = ((many == one) & (many > 0)).sum(axis=1) / either
    union = (size + sizes) / (1 + goal)
    spread = np.sqrt(goal * (1 - goal) / either * np.clip(1 - either / union, 0, 1))
    return share, share >= goal - SIGMAS * spread - 0.5 / either


def descend(paths: np.ndarray, tokens: np.ndarray, levels: int) -> np.ndarray:
    """Paths (rows by classes) after ``levels`` more levels; each has ``CHOICES`` children a level."""
    rows = np.arange(len(paths))[:, None]
    for _ in range(levels):
        first = (_mix(paths) % _U(COORDINATES)).astype(np.int64)
        children = []
        for k in range(CHOICES):
            chosen = (first + k * (COORDINATES // CHOICES) + k) % COORDINATES
            token = tokens[rows, chosen].astype(np.uint64)
            children.append(_mix(paths ^ _mix((token << _U(16)) + chosen.astype(np.uint64) + _U(1 << 40))))
        paths = np.concatenate(children, axis=1)
    return paths


def missed(percent: int, trees: int) -> float:
    """Chance that no tree keeps a pair at the threshold together through the first descent.

    The tokens that agree are as many as so many draws have it, and are the same in all trees.
    """
    s, total = percent / 100, 0.0
    for agree in range(COORDINATES + 1):
        p = 1.0
        for _ in range(DEPTH):
            p = 1 - (1 - agree / COORDINATES * p) ** CHOICES
        total += math.comb(COORDINATES, agree) * s**agree * (1 - s) ** (COORDINATES - agree) * (1 - p) ** trees
    return total


def trees_for(percent: int) -> int:
    """The fewest trees that miss a pair at the threshold with a chance of at most ``MISSED``."""
    for trees in range(1, MANY_TREES + 1):
        if missed(percent, trees) <= MISSED:
            return trees
    raise ValueError(f"a threshold of {percent} percent takes more than {MANY_TREES} trees; pass their number")


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in column), np.uint16).reshape(-1, COORDINATES)


def _features(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """key, n_shingles, set_id (128 bits of the set, null for an empty one), tokens and sketch of every row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("neardup")
        words = _Words()
        for batch in batches:
            sizes, ids, tokens, sketches = [], [], [], []
            for value in batch.column(1):
                raw = value.as_buffer()
                found = shingles(raw.to_pybytes() if raw is not None else b"", width, words)
                sizes.append(len(found))
                ids.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                tokens.append(minwise(found).tobytes() if len(found) else None)
                sketches.append(sketch(found) if len(found) else None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), *[pa.array(c, pa.binary()) for c in (ids, tokens, sketches)]]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_shingles", "set_id", "tokens", "sketch"])

    given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    return in_small_batches(given).mapInArrow(rows, "key long, n_shingles long, set_id binary, tokens binary, sketch binary")


def _first_paths(classes: DataFrame, trees: int) -> DataFrame:
    """(path, key) after the first descent, in all trees."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("neardup")
        roots = _mix(np.arange(1, trees + 1, dtype=np.uint64))
        for batch in batches:
            if batch.num_rows:
                tokens = _tokens(batch.column(1))
                paths = descend(np.tile(roots, (len(tokens), 1)), tokens, DEPTH)
                yield _path_rows(paths, batch.column(0))

    return classes.select("key", "tokens").mapInArrow(rows, "path long, key long")


def _path_rows(paths: np.ndarray, keys: pa.Array) -> pa.RecordBatch:
    key = np.repeat(keys.to_numpy(zero_copy_only=False).astype(np.int64), paths.shape[1])
    return pa.RecordBatch.from_arrays([pa.array(paths.ravel().view(np.int64)), pa.array(key)], names=["path", "key"])


def _deeper(members: DataFrame) -> DataFrame:
    """(path, key) of members (path, key, tokens), further down."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)[:, None]
                yield _path_rows(descend(at, _tokens(batch.column(2)), STEP), batch.column(1))

    return members.mapInArrow(rows, "path long, key long").distinct()


def _shared(paths: DataFrame) -> DataFrame:
    """(path, key, pivot) of nodes with at least two classes; the pivot is the smallest."""
    nodes = paths.groupBy("path").agg(F.min("key").alias("pivot"), F.max("key").alias("last"))
    nodes = nodes.where(F.col("pivot") < F.col("last")).select("path", "pivot")
    return materialize(paths.join(nodes, "path"), "nodes")


def having(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Semi or anti join with distinct keys. They are written and counted: up to ``BROADCAST_ROWS`` the texts stay where they are."""
    listed = materialize(keys, "listed-keys")
    return df.join(F.broadcast(listed) if listed.count() <= BROADCAST_ROWS else listed, key, how)


def _written(df: DataFrame, name: str) -> DataFrame:
    """A table of narrow rows, written and read back in few files: loops write many of these."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartition(max(1, parts // 16)), name)


def components(edges: DataFrame) -> DataFrame:
    """(key, label): the smallest key reachable from each key of ``edges`` (a, b) that is not it itself.

    Alternates two steps until nothing changes: every key points its larger neighbours, then its
    smaller ones, to the smallest it knows. Neighbourhoods are never gathered, only their minimum.
    """
    now = _written(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "links")
    mark = None
    while True:
        both = now.union(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min(F.least("hi", "lo")).alias("m"))
        larger = both.where(F.col("lo") > F.col("hi")).join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        smallest = larger.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = larger.join(smallest, "hi")
        smaller = joined.where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = _written(smaller.union(smallest.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if mark is not None and tuple(seen) == mark:
            return now.select(F.col("hi").alias("key"), F.col("lo").alias("label"))
        mark = tuple(seen)


def _squeezed(texts: DataFrame) -> DataFrame:
    """(key, text) with each text compressed for its way."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            small = pa.array([pack.compress(v.as_buffer()) for v in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), small], names=["key", "text"])

    return in_small_batches(texts).mapInArrow(rows, "key long, text binary")


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold.

    ``texts`` are compressed. Only those that a pair names move, once for each side.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("neardup")
        words, last, of_last, unpack = _Words(), None, None, zstandard.ZstdDecompressor()
        for batch in batches:
            kept = []
            for i, (b, ta, tb) in enumerate(zip(*(batch.column(c) for c in (1, 2, 3)), strict=True)):
                if b.as_py() != last:  # rows of one b stand together
                    last, of_last = b.as_py(), shingles(unpack.decompress(tb.as_buffer()), width, words)
                mine = shingles(unpack.decompress(ta.as_buffer()), width, words)
                same = len(np.intersect1d(mine, of_last, assume_unique=True))
                if 100 * same >= percent * (len(mine) + len(of_last) - same):
                    kept.append(i)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int32()))

    pairs = _written(pairs, "unconfirmed")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    texts = materialize(having(texts, wanted, "key", "left_semi"), "pair-texts")
    left = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    return in_small_batches(both).select("a", "b", "text_a", "text_b").mapInArrow(rows, "a long, b long")


def _compare(rows: DataFrame, percent: int, best_only: bool) -> DataFrame:
    """Candidate pairs (a, b) of ``rows`` (path, block, asks, key, label, n, sketch, paths), each named by one node.

    Rows that ask are compared with the block's other rows in another component.
    """

    def block(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy(zero_copy_only=False)
        key, label, n = (group[c].to_numpy(zero_copy_only=False) for c in ("key", "label", "n"))
        sketches = np.frombuffer(b"".join(v.as_buffer() for v in group["sketch"]), np.uint8).reshape(-1, BINS)
        path = group["path"][0].as_py()
        paths = group["paths"].to_pylist()
        rest = np.flatnonzero(~asks)
        a, b = [], []
        for q in np.flatnonzero(asks):
            # two rows that both ask meet where the smaller one asks
            other = rest[(label[rest] != label[q])]
            small, large = np.minimum(n[other], n[q]), np.maximum(n[other], n[q])
            other = other[100 * small >= percent * large]
            if not len(other):
                continue
            share, close = alike(sketches[q], sketches[other], n[q], n[other], percent / 100)
            other, share = other[close], share[close]
            if best_only and len(other):
                other = other[[np.argmax(share)]]
            mine = set(paths[q])
            for r in other:
                if best_only or min(mine.intersection(paths[r])) == path:
                    a.append(key[q])
                    b.append(key[r])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    found = rows.groupBy("path", "block").applyInArrow(block, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("key"))
    return members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))


def _live(members: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Members of nodes that hold several components, with label; and those nodes: path, size, outside, main label."""
    rows = _labelled(members, labels)
    by_label = rows.groupBy("path", "label").agg(F.count(F.lit(1)).alias("c"))
    nodes = by_label.groupBy("path").agg(
        F.sum("c").alias("size"), F.max(F.struct("c", "label")).alias("main"), F.count(F.lit(1)).alias("labels")
    )
    nodes = nodes.where("labels > 1").select("path", "size", (F.col("size") - F.col("main.c")).alias("outside"), F.col("main.label").alias("main"))
    nodes = _written(nodes, "live-nodes")
    return rows, nodes


def _dealt(rows: DataFrame, nodes: DataFrame, classes: DataFrame, best_only: bool) -> DataFrame:
    """Rows for ``_compare``: every class once in one block of its node, and those outside the main component asking in all blocks.

    For the best partner a class asks in ``BEST_NODES`` nodes, and nodes where none asks are left out.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.join(nodes, "path").select(
        "path", "key", "label", blocks.alias("blocks"), (F.col("label") != F.col("main")).alias("outside")
    )
    mine = rows.groupBy("key").agg(F.collect_list("path").alias("paths"))  # as many as a class has leaves
    rows = rows.join(mine, "key")
    if best_only:
        rows = rows.withColumn("outside", F.col("outside") & F.array_contains(F.slice(F.sort_array("paths"), 1, BEST_NODES), F.col("path")))
        rows = materialize(rows, "asking")
        rows = rows.join(rows.where("outside").select("path").distinct(), "path")
    # sketches move once a class, then with its few rows
    rows = rows.join(classes.select("key", "n", "sketch"), "key")
    home = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    places = F.concat(
        F.array(F.struct(home.alias("block"), F.lit(False).alias("asks"))),
        F.when(F.col("outside"), F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(b.alias("block"), F.lit(True).alias("asks")))).otherwise(
            F.array().cast("array<struct<block:int,asks:boolean>>")
        ),
    )
    return rows.select("path", F.inline(places), "key", "label", "n", "sketch", "paths")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", trees: int | None = None
) -> DataFrame:
    """key, n_shingles, component_id, kept: one row for each row of ``docs``.

    ``key`` must be a whole number. Linked are texts with 100 * intersection >= percent * union of
    their sets of distinct runs of ``width`` words; A-Z is lowered, words end at ASCII white space. A
    null or empty text, or one without words, has an empty set and is linked with nothing. Rows with a
    null key are linked with nothing either: their component is null and they are kept. Rows that
    repeat a key share its component; if their texts have different sets, all are judged by the smallest
    text. Other columns of ``docs`` are not read. ``trees`` follows from the threshold unless it is given.
    Runs several jobs.
    """
    trees = trees_for(percent) if trees is None else trees
    features = materialize(_features(docs, key, text, width), "shingles")
    whole = features.where(F.col("key").isNotNull() & F.col("set_id").isNotNull())
    per_key = whole.groupBy("key").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"), F.count(F.lit(1)).alias("rows"))
    odd, most = per_key.agg(F.count_if(F.col("low") != F.col("high")), F.max("rows")).first()
    if odd:  # a key must name one set
        one = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias(key)).agg(F.min(text).alias(text))
        found = near_duplicates(one, width, percent, key, text, trees)
        rows = docs.select(F.col(key).cast("long").alias(key)).join(found, key, "left")
        return rows.withColumns({"n_shingles": F.coalesce("n_shingles", F.lit(0).cast("long")), "kept": F.coalesce("kept", F.lit(True))})
    sets = materialize(whole.groupBy("set_id").agg(F.min("key").alias("class"), F.first("n_shingles").alias("n")), "classes")
    named = sets.select(F.col("class").alias("key"), "set_id", "n")
    tokens = whole.select("key", "set_id", "tokens", "sketch")
    # a repeated key with another text has another set; equal rows have equal tokens
    classes = materialize(tokens.join(named, ["key", "set_id"]).dropDuplicates(["key", "set_id"]).select("key", "n", "tokens", "sketch"), "tokens")

    members = _shared(_first_paths(classes, trees))
    links: list[DataFrame] = []
    labels: DataFrame | None = None
    texts: DataFrame | None = None
    depth, per_class = DEPTH, trees * CHOICES**DEPTH

    def texts_of(rows: DataFrame) -> DataFrame:
        wanted = rows.select("key").distinct().join(sets.select(F.col("class").alias("key")).distinct(), "key")
        given = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text")).where("key is not null and text is not null")
        found = _squeezed(having(given, wanted, "key", "left_semi"))
        # rows that repeat a key have the same set, so any text of them will do
        return materialize(found.dropDuplicates(["key"]) if most > 1 else found, "texts")

    def add(pairs: DataFrame) -> bool:
        """Confirm pairs and merge their components."""
        nonlocal labels
        sure = _written(_confirm(pairs, texts, width, percent), "confirmed")
        if sure.isEmpty():
            return False
        known = [] if labels is None else [labels.select(F.col("key").alias("a"), F.col("label").alias("b"))]
        labels = components(reduce(DataFrame.union, [sure.select("a", "b"), *known]))
        return True

    while True:
        if members.isEmpty():
            break
        if texts is None:
            texts = texts_of(members)
        stars = members.where("key <> pivot").groupBy("key", "pivot").agg(F.count(F.lit(1)).alias("c"))
        best = stars.groupBy("key").agg(F.max(F.struct("c", (-F.col("pivot")).alias("p"))).alias("m"))
        # half of what a pair at the threshold shares; the others are met below
        enough = F.col("m.c") >= (per_class * (percent / 100) ** depth / 2 if depth == DEPTH else 1)
        add(best.where(enough).select(F.col("key").alias("a"), (-F.col("m.p")).alias("b")))
        best_only, compared = True, None
        while True:
            rows, nodes = _live(members, labels)
            work = F.col("size") * F.col("outside")
            fit = nodes.where((work <= NODE_WORK) | F.lit(depth >= MAX_DEPTH))
            if compared is not None:
                fit = fit.join(compared, "path", "left_anti")
            if fit.isEmpty():
                break
            found = _written(_compare(_dealt(rows, fit, classes, best_only), percent, best_only), "candidates")
            if not best_only:  # merging may bring further nodes under the limit: they are next
                done = fit.select("path")
                compared = done if compared is None else compared.union(done)
            if not found.isEmpty():
                add(found)
            best_only = False
        # a node's work only shrinks, so none of those compared is among these
        heavy = nodes.where(F.col("size") * F.col("outside") > NODE_WORK)
        if depth >= MAX_DEPTH or heavy.isEmpty():
            break
        below = rows.select("path", "key").join(heavy.select("path"), "path").join(classes.select("key", "tokens"), "key")
        members = _shared(_deeper(below.select("path", "key", "tokens")))
        depth += STEP

    joined = features.select("key", "n_shingles", "set_id").join(sets.select("set_id", "class"), "set_id", "left")
    if labels is not None:
        joined = joined.join(labels.select(F.col("key").alias("class"), "label"), "class", "left")
    else:
        joined = joined.withColumn("label", F.lit(None).cast("long"))
    component = F.when(F.col("key").isNotNull(), F.coalesce("label", "class", "key"))
    kept = F.coalesce(component == F.col("key"), F.lit(True))
    return joined.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), kept.alias("kept"))


@query(
    "op3_minhash_near_dedup",
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS ws
        FROM documents
    ),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS s
        FROM d
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
    ),
    reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
    FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
    """,
)
def op3(spark, sf_dir):
    """All documents by shared three-word runs at 85 percent."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)
