"""How the sources of a language differ from each other and from the language, by counts of terms.

Terms are maximal runs of letters (A-Z lowered) and characters beyond ASCII. A language keeps the terms
of at least ``LEAST_DOCUMENTS`` of its documents, V in number. A group is a (lang, source) that occurs,
and a kept term counted c times in a group (or language) of N kept terms in all has there the share
p = 1 + floor(10^9 (c + 1) / (N + V)). How far a share p is from a share q is f = floor((p - q)^2 / q).

f depends on the two counts alone, so terms are not judged one by one but by *count cells*: all terms
with the same pair of counts are one cell with a multiplicity, and there are far fewer cells than terms.

* Terms that a group uses more than its language: cells of (group count, lang count) are valued, cells
  of equal value merged, values ranked and their multiplicities summed until the report is full. Only
  the terms of those cells are then looked up and put into UTF-8 order.
* Distances between sources: cells of (count here, count there), with zeros, in blocks of terms. A
  block's cells are valued in place and only the sums of f are shuffled: one number a pair and block.

Texts are counted in the tasks that read them, and a hot source or term is a few rows a task by then.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import attach
from ..session import materialize
from .registry import query, table

LEAST_DOCUMENTS, RANKS = 3, 200
ONE = 1_000_000_000
#: Counts that a task holds before it passes them on.
HELD = 250_000
#: Count rows of a block of terms, sources of a tile, and numbers of a dense part of a block.
BLOCK_ROWS, TILE, DENSE = 200_000, 256, 2_000_000

_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: dict[tuple, Counter] = defaultdict(Counter)
        holders: dict[tuple, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for (of_lang, of_source), counts in uses.items():
                held = holders[of_lang, of_source]
                n, size = list(counts.values()), len(counts)
                columns = [pa.array([v] * size, pa.binary()) for v in (of_lang, of_source)]
                columns += [pa.array(list(counts), pa.binary()), pa.array(n, pa.int64()), pa.array([held[t] for t in counts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

        size = 0
        for batch in batches:
            for of_lang, of_source, value in zip(*batch.columns, strict=True):
                words = terms_of(value.as_buffer().to_pybytes())
                if not words:
                    continue
                group = of_lang.as_py(), of_source.as_py()
                counts, before = uses[group], len(uses[group])
                counts.update(words)
                holders[group].update(set(words))
                size += len(counts) - before
                if size >= HELD:
                    yield from flush()
                    uses.clear()
                    holders.clear()
                    size = 0
        yield from flush()

    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    found = given.mapInArrow(rows, "lang binary, source binary, term binary, n long, docs long")
    keys = [F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")]
    return found.select(*keys, "n", "docs").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str) -> str:
    """SQL of p, in whole numbers: ``total`` and ``v`` are columns."""
    return f"1 + (CAST({ONE} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(19,0))) div CAST({total} + v AS DECIMAL(29,0))"


def _cells(one: np.ndarray, other: np.ndarray, width: int, widths: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of count numbers that occur, and how often."""
    code = one * widths + other
    if width * widths <= 4 * len(code) + 1024:
        times = np.bincount(code, minlength=width * widths)
        at = np.flatnonzero(times)
        times = times[at]
    else:
        at, times = np.unique(code, return_counts=True)
    return at // widths, at % widths, times


def block_distances(counts: np.ndarray, totals: list[int], vs: list[int], pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sum of f over a block of terms for each pair of sources, in both directions.

    ``counts`` has a row for each source and a column for each term.
    """
    values, numbers = [], []
    for row, total, v in zip(counts, totals, vs):
        kinds, inverse = np.unique(row, return_inverse=True)
        values.append(np.array([1 + ONE * (c + 1) // (total + v) for c in kinds.tolist()], np.int64))
        numbers.append(inverse)
    out = []
    for a, b in pairs:
        i, j, times = _cells(numbers[a], numbers[b], len(values[a]), len(values[b]))
        p, q = values[a][i], values[b][j]
        square = (p - q) ** 2
        out.append((int((square // q * times).sum()), int((square // p * times).sum())))
    return out


def _distances(kept: DataFrame, vocabulary: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every two sources of a language.

    Blocks hold about ``BLOCK_ROWS`` counts. Where a language has more than ``TILE`` sources, a block
    takes the sources of two tiles at a time; terms that both tiles lack are one more cell, of two zeros.
    """

    def block(rows: pa.Table) -> pa.Table:
        lang, (low, high) = rows["lang"][0], (rows[c][0].as_py() for c in ("low", "high"))
        told = rows.filter(pc.is_null(rows["term"]))
        names, tiles = told["source"].to_pylist(), told["tile"].to_pylist()
        place = {name: i for i, name in enumerate(names)}
        pairs = [(i, j) for j in range(len(names)) for i in range(j) if low == high or tiles[i] != tiles[j]]
        sums = np.zeros((len(pairs), 2), dtype=object)
        totals, vs, unseen = told["total"].to_pylist(), told["v"].to_pylist(), told["terms"][0].as_py() or 0
        counted = rows.filter(pc.is_valid(rows["term"]))
        if counted.num_rows and pairs:
            coded = counted["term"].combine_chunks().dictionary_encode()
            term = coded.indices.to_numpy(zero_copy_only=False)
            source = np.array([place[s] for s in counted["source"].to_pylist()], np.int64)
            n = counted["n"].to_numpy()
            order = np.argsort(term, kind="stable")
            term, source, n = term[order], source[order], n[order]
            step = max(1, DENSE // len(names))
            unseen -= len(coded.dictionary)
            for at in range(0, len(coded.dictionary), step):
                first, last = np.searchsorted(term, [at, at + step])
                dense = np.zeros((len(names), min(step, len(coded.dictionary) - at)), np.int64)
                dense[source[first:last], term[first:last] - at] = n[first:last]
                sums += np.array(block_distances(dense, totals, vs, pairs), dtype=object)
        if unseen and pairs:
            sums += unseen * np.array(block_distances(np.zeros((len(names), 1), np.int64), totals, vs, pairs), dtype=object)
        both = [(names[a], names[b], int(s[0])) for (a, b), s in zip(pairs, sums)] + [(names[b], names[a], int(s[1])) for (a, b), s in zip(pairs, sums)]
        columns = [pa.array([lang.as_py()] * len(both), pa.string())]
        columns += [pa.array([x[0] for x in both], pa.string()), pa.array([x[1] for x in both], pa.string()), pa.array([x[2] for x in both], pa.int64())]
        return pa.table(columns, names=["lang", "source", "item", "value"])

    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.sum("kept_rows").alias("rows"))
    sizes = sizes.select("lang", F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK_ROWS)).cast("int").alias("blocks"), F.ceil(F.col("sources") / TILE).cast("int").alias("tiles"))
    none = F.lit(None)
    counted = attach(kept, sizes, ["lang"], "inner").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    counted = counted.select("lang", "source", "term", "n", none.cast("long").alias("total"), none.cast("long").alias("v"), none.cast("long").alias("terms"), "block", "tiles")
    told = attach(groups, sizes, ["lang"], "inner").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    per_block = attach(vocabulary, sizes, ["lang"], "inner").groupBy("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"))
    told = told.join(per_block.agg(F.count(F.lit(1)).alias("terms")), ["lang", "block"], "left")
    told = told.select("lang", "source", none.cast("string").alias("term"), none.cast("long").alias("n"), "total", "v", "terms", "block", "tiles")
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    rows = counted.union(told).withColumn("tile", tile)
    met = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least("tile", t).alias("low"), F.greatest("tile", t).alias("high")))
    rows = rows.select("lang", "source", "term", "n", "total", "v", "terms", "block", "tile", F.inline(met))
    each = rows.groupBy("lang", "block", "low", "high").applyInArrow(block, "lang string, source string, item string, value long")
    return each.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _telling_terms(kept: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    """lang, source, item, value, rank of the terms that a group uses more than its language."""
    group = ["lang", "source"]
    cells = kept.groupBy(*group, "n", "lang_n").agg(F.count(F.lit(1)).alias("times"))
    cells = attach(cells, groups.select(*group, "total", "v", "lang_total"), group, "inner")
    cells = cells.withColumns({"p": F.expr(share("n", "total")), "q": F.expr(share("lang_n", "lang_total"))}).where("p > q")
    cells = materialize(cells.select(*group, "n", "lang_n", "times", F.expr("((p - q) * (p - q)) div q").alias("value")), "cells")
    # cells of equal value are one; a value has a term at least, so the first values are enough
    best = Window.partitionBy(*group).orderBy(F.desc("value"))
    values = cells.groupBy(*group, "value").agg(F.sum("times").alias("times")).withColumn("place", F.row_number().over(best)).where(F.col("place") <= ranks)
    values = values.withColumn("above", F.sum("times").over(best) - F.col("times")).where(F.col("above") < ranks)
    cut = values.groupBy(*group).agg(F.min("value").alias("cut"))
    chosen = attach(cells.select(*group, "n", "lang_n", "value"), cut, group, "inner").where("value >= cut").drop("cut")
    terms = attach(kept.select(*group, "term", "n", "lang_n"), chosen, [*group, "n", "lang_n"], "inner")
    # tasks drop all but the first rows of a group before the shuffle
    order = Window.partitionBy(*group).orderBy(F.desc("value"), F.asc("term"))
    ranked = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return ranked.select(*group, F.col("term").alias("item"), "value", "rank")


def audit(
    docs: DataFrame, ranks: int = RANKS, least_documents: int = LEAST_DOCUMENTS, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """lang, source, part, item, value, rank: other sources by distance, and the group's telling terms.

    Part ``pair`` lists for each group every other source of its language with the sum of f over all kept
    terms (p the group's, q the other's; 0 where the language keeps no term). Part ``term`` lists the
    kept terms of the group with p above the language's share q, down to rank ``ranks``. Ranks count
    from 1 by value, larger first, then by the item's UTF-8 bytes. A null text, lang or source counts as
    empty; a group without terms has pairs and shares too. Every row is a document of its own, repeated
    or not. Other columns are not read. Runs several jobs.
    """
    group = ["lang", "source"]
    counts = materialize(term_counts(docs, lang, source, text), "term-counts")
    vocabulary = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    vocabulary = materialize(vocabulary.where(F.col("docs") >= least_documents).select("lang", "term", "lang_n"), "vocabulary")
    kept = materialize(counts.select(*group, "term", "n").join(vocabulary, ["lang", "term"]), "kept-terms")
    occurring = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]).distinct()
    sums = kept.groupBy(*group).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kept_rows"))
    whole = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = materialize(occurring.join(sums, group, "left").join(whole, "lang", "left").na.fill(0), "groups")

    pairs = _distances(kept, vocabulary, groups)
    order = Window.partitionBy(*group).orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.select(*group, F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = _telling_terms(kept, groups, ranks)
    return pairs.unionByName(terms.select(*group, F.lit("term").alias("part"), "item", "value", "rank"))


@query(
    "op12_source_divergence",
    r"""
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
    w AS (SELECT id, lang, source, unnest(ws) AS term FROM d),
    k AS (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT id) >= 3),
    g AS (SELECT DISTINCT lang, source FROM d),
    vs AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
    c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY 1, 2, 3),
    filled AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    shares AS (SELECT f.*, CAST(1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS BIGINT) AS p FROM filled f JOIN vs USING (lang)),
    whole AS (SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)) AS BIGINT) AS q
        FROM filled JOIN vs USING (lang) GROUP BY lang, term),
    apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
    rows_of AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
    ),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM rows_of)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
)
def op12(spark, sf_dir):
    """All documents: every language's sources against each other, and the first 200 telling terms of each."""
    return audit(table(spark, sf_dir, "documents"))
