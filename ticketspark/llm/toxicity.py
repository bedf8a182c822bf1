"""Toxicity by compression distance: two zstandard dictionaries, one score.

A window is a word between spaces (runs of digits, letters and characters beyond ASCII, A-Z lowered;
longer words are cut into pieces of ``PIECE`` bytes). It is compressed once with a dictionary trained
on toxic text and once with one trained on ordinary text. The difference of the two lengths is the
window's gain: the bytes by which toxic text explains it better. Every window is compressed together
with a short carrier that both dictionaries end in. Without it a short window is stored as it is, and
both lengths are alike.

Toxic rows consist mostly of ordinary words, so the toxic dictionary is trained on those windows of
toxic rows that hold a run of ``GRAM`` bytes which far more toxic than ordinary rows hold. A long ordinary
text holds many runs once, so it counts for a run by the share of its parts of ``PART`` windows that hold it.

A text's features are its largest gain, the numbers of windows beyond some gains, also of those that
the toxic dictionary holds whole (they cost one match, ``WHOLE`` bytes beyond the carrier's) or nearly,
its number of windows and shares of it. A logistic curve, fitted on labelled rows that the dictionaries have not
seen, turns them into the probability that the label is 1.

The sample is bounded: ``TOXIC_ROWS`` and ``ORDINARY_ROWS`` labelled rows, chosen by a hash of their
id. Learning and scoring read whole texts. Texts stay in the tasks: the driver gets byte runs with their
counts, the windows that the dictionaries are trained on, and the features of rows that fit the curve.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import in_small_batches, materialize
from .licenses import normalised
from .registry import query, table
from .worker import held

#: Bounds of the training sample: rows of each label.
TOXIC_ROWS, ORDINARY_ROWS = 2000, 6000
#: Share of the sampled rows that fit the curve; the others train the dictionaries.
CURVE_SHARE = 0.4
PIECE, GRAM = 48, 5
#: How much likelier in toxic rows a run of bytes must be; the value with the better curve is taken.
ODDS = (20.0, 6.0)
TOXIC_BYTES, ORDINARY_BYTES, LEVEL = 6000, 65536, 6
#: Windows in a part of an ordinary text, and what a text counts for.
PART, UNIT = 1500, 1 << 20
#: Windows that the ordinary dictionary is trained on.
USUAL = 120_000
CARRIER = bytes(c for c in range(1, 32) if c not in (9, 10, 13))
#: Costs of single windows that a worker remembers.
REMEMBERED = 300_000
#: What one match costs, and the number of features.
WHOLE, FEATURES = 3, 13


def windows(text: bytes) -> list[bytes]:
    words = normalised(text).split()
    if not words or max(map(len, words)) <= PIECE:
        return [b" %b " % w for w in words]
    return [b" %b " % w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]


def _mixed(items: Iterable[bytes]) -> list[bytes]:
    """A fixed shuffled order."""
    return sorted(items, key=lambda w: (zlib.crc32(w), w))


def _train(found: list[bytes], size: int) -> bytes:
    samples = [b"".join(found[i : i + 8]) for i in range(0, len(found), 8)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: its most frequent windows serve
        frequent = [w for w, _ in Counter(found).most_common()]
        return b"".join(reversed(frequent))[-size:]


class Costs(dict):
    """Bytes that a window adds to the carrier's with either dictionary, computed when first asked for.

    Both are held in one number, toxic times 256 plus ordinary.
    """

    def __init__(self, toxic: bytes, ordinary: bytes):
        super().__init__()
        self._toxic, self._ordinary = (self._compressor(d) for d in (toxic, ordinary))
        self._bare = len(self._toxic.compress(CARRIER)) * 256 + len(self._ordinary.compress(CARRIER))

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(content + CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=64, dict_size=len(content), write_content_size=0, write_checksum=0, write_dict_id=0
        )
        d.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=d, compression_params=how)

    def __missing__(self, window: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        carried = window + CARRIER
        cost = len(self._toxic.compress(carried)) * 256 + len(self._ordinary.compress(carried)) - self._bare
        self[window] = cost
        return cost

    def features(self, text: bytes) -> list[float]:
        found = windows(text)
        if not found:
            return [0.0] * FEATURES
        costs = np.fromiter(map(self.__getitem__, found), np.int32, len(found))
        toxic = costs >> 8
        gains = (costs & 255) - toxic
        whole, nearly = toxic <= WHOLE, toxic <= WHOLE + 2
        counts = [int(n) for n in (
            *((whole & (gains >= t)).sum() for t in (2, 3, 4, 5)),
            *((nearly & (gains >= t)).sum() for t in (2, 4)),
            *((gains >= t).sum() for t in (4, 5, 6)),
        )]
        return [
            min(float(gains.max()), 12.0) / 4,
            *[math.log1p(n) for n in counts],
            math.log1p(len(found)),
            20.0 * counts[1] / len(found),
            20.0 * counts[7] / len(found),
        ]


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the curve's weights, about 70 kB; without dictionaries, a constant score."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]

    def score(self, costs: Costs, text: bytes) -> float:
        x = [1.0, *costs.features(text)] if self.toxic else [1.0]
        z = sum(a * b for a, b in zip(self.weights, x, strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Logistic weights by Newton steps, slightly drawn to zero."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - ridge * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
    return w


def _cut(n: int) -> int:
    """How many of ``n`` texts of a label, in their mixed order, train the dictionaries."""
    return max(1, round(n * (1 - CURVE_SHARE)))


def _grams(found: Iterable[bytes]) -> set[bytes]:
    return {w[i : i + GRAM] for w in found for i in range(len(w) - GRAM + 1)}


def _held(text: bytes, label: int) -> dict[bytes, int]:
    """What a text counts for each run it holds, in whole numbers whose sums do not depend on their order."""
    found = windows(text)
    if label:
        return dict.fromkeys(_grams(set(found)), 1)
    parts = [set(found[i : i + PART]) for i in range(0, len(found), PART)]
    return {g: n * UNIT // len(parts) for g, n in Counter(g for part in parts for g in _grams(part)).items()}


def _spread(found: list[bytes]) -> list[bytes]:
    # numbered first, so that repeated windows are spread too
    return [w for _, w in sorted((zlib.crc32(b"%d" % i), w) for i, w in enumerate(found))]


class _Texts:
    """A sample held in lists: the first texts of each label train the dictionaries, the others fit the curve."""

    def __init__(self, toxic: list[bytes], ordinary: list[bytes]):
        toxic, ordinary = _mixed(set(toxic)), _mixed(set(ordinary) - set(toxic))
        self.sizes = len(toxic), len(ordinary)
        cuts = [_cut(n) for n in self.sizes]
        self._train = toxic[: cuts[0]], ordinary[: cuts[1]]
        self._curve = toxic[cuts[0] :], ordinary[cuts[1] :]

    def grams(self, least: int) -> list[tuple[bytes, int, int]]:
        """Runs of ``GRAM`` bytes that at least so many toxic texts hold, that number, and what ordinary texts count."""
        toxic, ordinary = Counter(), Counter()
        for label, total in ((1, toxic), (0, ordinary)):
            for t in self._train[1 - label]:
                total.update(_held(t, label))
        return [(g, n, ordinary[g]) for g, n in toxic.items() if n >= least]

    def usual(self) -> list[bytes]:
        """The first ``USUAL`` of the spread windows of ordinary texts."""
        return _spread([w for t in self._train[1] for w in sorted(set(windows(t)))])[:USUAL]

    def marked(self, telling: set[bytes]) -> list[bytes]:
        """Windows of toxic texts that hold a telling run, text by text."""
        return [w for t in self._train[0] for w in sorted(set(windows(t))) if _grams([w]) & telling]

    def features(self, models: list[Model]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Features and labels of the texts for the curve, for each model."""
        y = np.array([1.0] * len(self._curve[0]) + [0.0] * len(self._curve[1]))
        out = []
        for model in models:
            costs = Costs(model.toxic, model.ordinary)
            out.append((np.array([costs.features(t) for part in self._curve for t in part]), y))
        return out


class _Rows:
    """The same of a table (_label, _text, _digest) with few rows of any length, whose texts stay in the tasks."""

    def __init__(self, rows: DataFrame):
        # at most as many short rows as are sampled
        heads = rows.select("_label", F.crc32("_text").alias("crc"), "_digest").distinct().collect()
        toxic = {(r["crc"], r["_digest"]) for r in heads if r["_label"] == 1}
        ordinary = {(r["crc"], r["_digest"]) for r in heads if r["_label"] == 0} - toxic
        self.sizes = len(toxic), len(ordinary)
        places = [
            (digest, label, at, at < _cut(len(found)))
            for label, found in ((1, toxic), (0, ordinary))
            for at, (_, digest) in enumerate(sorted(found))
        ]
        listed = rows.sparkSession.createDataFrame(places, "_digest string, _label int, _at long, _trains boolean")
        placed = rows.join(F.broadcast(listed), ["_digest", "_label"]).dropDuplicates(["_digest"])
        placed = materialize(placed.select("_label", "_at", "_trains", "_text"), "toxicity-sample")
        placed = in_small_batches(placed)
        self._curve = placed.where(~F.col("_trains")).select("_label", "_at", "_text")

        def distinct(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
            for batch in batches:
                found = [sorted(set(windows(t))) for t in batch["_text"]]
                yield pd.DataFrame({"_label": batch["_label"], "_at": batch["_at"], "n": [len(f) for f in found], "windows": found})

        self._learned = placed.where("_trains").select("_label", "_at", "_text")
        self._train = materialize(self._learned.mapInPandas(distinct, "_label int, _at long, n long, windows array<binary>"), "toxicity-windows")

    def grams(self, least: int) -> list[tuple[bytes, int, int]]:
        def counted(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
            for batch in batches:
                for label, rows in batch.groupby("_label"):
                    found: Counter = Counter()
                    for t in rows["_text"]:
                        found.update(_held(t, label))
                    yield pd.DataFrame({"g": list(found), "n": [n * label for n in found.values()], "m": [n * (1 - label) for n in found.values()]})

        counts = self._learned.select("_label", "_text").mapInPandas(counted, "g binary, n long, m long")
        held = counts.groupBy("g").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).where(F.col("n") >= least)
        return [(bytes(r["g"]), r["n"], r["m"]) for r in held.collect()]

    def usual(self) -> list[bytes]:
        ordinary = self._train.where("_label = 0")
        # narrow rows, as many as are sampled
        sizes = ordinary.select("_at", "n").orderBy("_at").collect()
        ends = np.cumsum([r["n"] for r in sizes]).tolist()
        first = self._train.sparkSession.createDataFrame([(r["_at"], end - r["n"]) for r, end in zip(sizes, ends, strict=True)], "_at long, first long")
        each = ordinary.join(F.broadcast(first), "_at").select("first", F.posexplode("windows").alias("i", "w"))
        place = F.crc32((F.col("first") + F.col("i")).cast("string").cast("binary")).alias("place")
        return [bytes(r["w"]) for r in each.select(place, "w").orderBy("place", "w").limit(USUAL).collect()]

    def marked(self, telling: set[bytes]) -> list[bytes]:
        def tells(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
            for batch in batches:
                found = [(at, w) for at, f in zip(batch["_at"], batch["windows"], strict=True) for w in f if _grams([w]) & telling]
                yield pd.DataFrame(found, columns=["_at", "w"])

        rows = self._train.where("_label = 1").select("_at", "windows").mapInPandas(tells, "_at long, w binary").collect()
        return [w for _, w in sorted((r["_at"], bytes(r["w"])) for r in rows)]

    def features(self, models: list[Model]) -> list[tuple[np.ndarray, np.ndarray]]:
        def of(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
            costs = [Costs(m.toxic, m.ordinary) for m in models]
            for batch in batches:
                x = [[v for c in costs for v in c.features(t)] for t in batch["_text"]]
                yield pd.DataFrame({"_label": batch["_label"], "_at": batch["_at"], "x": x})

        rows = self._curve.mapInPandas(of, "_label int, _at long, x array<double>").collect()
        rows = sorted(rows, key=lambda r: (-r["_label"], r["_at"]))
        x, y = np.array([r["x"] for r in rows]), np.array([float(r["_label"]) for r in rows])
        return [(x[:, i * FEATURES : (i + 1) * FEATURES], y) for i in range(len(models))]


def fit(toxic: list[bytes], ordinary: list[bytes], prior: float) -> Model:
    """Model of two lists of texts. ``prior`` is the share of label 1 among the labelled rows.

    Without texts of both labels the score is the prior, for every text.
    """
    return _fit(_Texts(toxic, ordinary), prior)


def _fit(sample: _Texts | _Rows, prior: float) -> Model:
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    constant = Model(b"", b"", (math.log(prior / (1 - prior)),))
    if min(sample.sizes) < 2:
        return constant
    n_toxic, n_ordinary = (_cut(n) for n in sample.sizes)
    ratio = (n_ordinary + 1) / (n_toxic + 1)
    odds = {g: (n + 0.5) / (m / UNIT + 0.5) * ratio for g, n, m in sample.grams(max(2, round(n_toxic / 150)))}
    usual = sample.usual()
    if not usual:
        return constant
    ordinary_dictionary = _train(usual, ORDINARY_BYTES)
    telling = [{g for g, o in odds.items() if o >= goal} for goal in ODDS]
    every = sample.marked(set().union(*telling))
    models = []
    for runs in telling:
        marked = [w for w in every if _grams([w]) & runs]
        if marked:
            size = min(TOXIC_BYTES, max(512, sum(map(len, marked)) // 8))
            models.append(Model(_train(_spread(marked), size), ordinary_dictionary, ()))
    best, least_loss = constant, math.inf
    for model, (x, y) in zip(models, sample.features(models) if models else [], strict=True):
        w = _curve(x, y)
        z = np.clip(np.column_stack([np.ones(len(x)), x]) @ w, -30, 30)
        loss = float(np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z)))))
        if loss < least_loss:
            best, least_loss = replace(model, weights=tuple(float(v) for v in w)), loss
    return best


def learn(labelled: DataFrame, docs: DataFrame, key: str = "doc_id", label: str = "toxic", text: str = "text") -> Model:
    """Model from ``labelled`` (key, label), which must hold only rows that may be learned from.

    Rows are chosen by a hash of their key, so the sample does not depend on files or partitions. At
    most ``TOXIC_ROWS + ORDINARY_ROWS`` keys are chosen, and no texts come to the driver. Rows without a label, a key
    or a text are left out; a repeated key counts once for each of its labels, with the text of the
    smallest hash if ``docs`` has several.
    """
    known = labelled.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    known = known.distinct()
    chosen = [
        known.where(F.col("_label") == value).orderBy(F.xxhash64("_key"), "_key").limit(n)
        for value, n in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS))
    ]
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text"))
    # both bounds are above: the chosen keys are few enough to broadcast
    rows = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "_key").withColumn("_digest", F.sha2("_text", 256))
    # a key may be repeated in any number of rows: one text of each goes on
    one = materialize(rows.groupBy("_key", "_label").agg(F.min("_digest").alias("_digest")), "toxicity-keys")
    rows = rows.join(F.broadcast(one), ["_key", "_label", "_digest"]).dropDuplicates(["_key", "_label"])
    rows = materialize(rows.select("_label", "_text", "_digest"), "toxicity-rows")
    share = known.agg(F.avg("_label")).first()[0]
    return _fit(_Rows(rows), 0.5 if share is None else share)


def _costs(model: Model) -> Costs:
    """A worker's memory of costs, kept from task to task."""
    return held("toxicity", model, lambda: Costs(model.toxic, model.ordinary))


def score_texts(df: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1 for each whole text; a null text counts as empty.

    Only the text goes to Python; nothing is shuffled. An empty text gets the curve's value for no
    windows. A column named as the score is replaced.
    """

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        costs = _costs(model)
        return pd.Series([model.score(costs, t) for t in texts], dtype="float64")

    given = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return in_small_batches(df).withColumn(score, scored(given))


def held_out(key: Column) -> Column:
    """Rows that must not be learned from: the remainder 1 of the crc of their id."""
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def learn_from(documents: DataFrame, labels: DataFrame) -> Model:
    return learn(labels.where(~F.coalesce(held_out(F.col("doc_id")), F.lit(True))), documents)


@query("op9_toxicity")
def op9(spark, sf_dir):
    """All documents scored."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn_from(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score_texts(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
