"""Importance resampling, source divergence and the token-group join: plain versions and edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_queries import near_duplicate_classes
from ticketspark.llm import divergence, resampling, tokengroups

LONG = "word " * 60_000 + "x" * 50_000
TEXTS = [None, "", "   \n\t ", "one", "Same text here", "Same text here", "Ünïted NATIONS 42 b-c", LONG, "é\x00 \N{EM SPACE}日本語", "a b c " * 40]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, n_words long, rank string, weight string, "
    "part string, item string, value string, planes string, totals string, key string, group string, token string, label string, component_id string, term string"
)


@pytest.fixture(scope="module")
def docs(spark):
    """Ids with a null and a repeated row, null langs and sources, and columns named as the operators' own."""
    rows = [(None if i == 3 else i, t, None if i == 4 else "en", None if i % 4 == 0 else f"s{i % 3}", 1, 0.5, True, 7, *["x"] * 13) for i, t in enumerate(TEXTS)]
    rows.append(rows[5])
    return spark.createDataFrame(rows, SCHEMA)


def plain_resampled(given, target, percent, least, seed, shortest, longest, buckets):
    def features(text):
        words = [w for w in re.split(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) if w]
        return len(words), [b" ".join(words[i : i + n]) for n in range(shortest, longest + 1) for i in range(len(words) - n + 1)]

    code = lambda fs: [zlib.crc32(f) % buckets for f in fs]
    coded = [(k, n, code(fs)) for k, (n, fs) in ((k, features(t)) for k, t in given)]
    s, t = Counter(b for _, _, c in coded for b in c), Counter(b for x in target for b in code(features(x)[1]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets))))
    rows = []
    for k, n, c in coded:
        weight = sum(map(gain, c)) // len(c) if c else 0
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append([k, n, len(c), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = [(r[0], r[2], r[3], r[4], i + 1) for i, r in enumerate(able[: len(able) * percent // 100])]
    rest = Counter((r[0], r[2], r[3], r[4], None) for r in rows) - Counter((*d[:4], None) for d in drawn)
    return sorted([*drawn, *rest.elements()], key=str)


@pytest.mark.parametrize("shortest,longest,percent,least,buckets", [(1, 1, 10, 20, 10_000), (1, 3, 50, 1, 100), (2, 2, 100, 0, 64)])
def test_resample(spark, docs, shortest, longest, percent, least, buckets):
    target = ["one text here", None, "a b c d"]
    got = resampling.resample(
        docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, least, shortest=shortest, longest=longest, buckets=buckets
    )
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == plain_resampled(given, target, percent, least, "2024", shortest, longest, buckets)


def test_resample_nothing(docs):
    assert resampling.resample(docs.limit(0), docs.limit(0)).count() == 0
    rows = resampling.resample(docs, docs.limit(0), least_words=0, percent=100).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 12))


def test_planes_sum_exactly():
    rng = np.random.default_rng(0)
    owner, bucket = np.repeat(np.arange(5), [0, 3, 4000, 1, 50]), rng.integers(0, 100, 4054)
    bucket[3:4003] %= 3
    gains = rng.integers(-5000, 5000, 100)
    width = resampling.plane_bytes(100)
    planes, factors = resampling.gain_planes(gains)
    for i, packed in enumerate(resampling.planes_of(owner, bucket, 5, 100)):
        flat = np.frombuffer(packed, np.uint64).reshape(-1, width // 8)
        assert resampling.summed(flat, np.arange(len(flat)), planes, factors).sum() == gains[bucket[owner == i]].sum()


def plain_audit(rows, ranks, least):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        words = [w for w in re.split(r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        groups.add((lang, source))
        counts[lang, source].update(words)
        held[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = [w for w, n in held[lang].items() if n >= least]
        of = {s: counts[lang, s] for at, s in groups if at == lang}
        total = {s: sum(c[w] for w in kept) for s, c in of.items()}
        p = {s: {w: 1 + 10**9 * (c[w] + 1) // (total[s] + len(kept)) for w in kept} for s, c in of.items()}
        whole, n = {w: sum(c[w] for c in of.values()) for w in kept}, sum(total.values())
        q = {w: 1 + 10**9 * (whole[w] + 1) // (n + len(kept)) for w in kept}
        pairs = [(sum((p[source][w] - p[s][w]) ** 2 // p[s][w] for w in kept), s) for s in of if s != source]
        terms = [((p[source][w] - q[w]) ** 2 // q[w], w) for w in kept if of[source][w] and p[source][w] > q[w]]
        for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


@pytest.mark.parametrize("ranks,least,block,tile", [(200, 3, 200_000, 256), (2, 1, 3, 1)])
def test_audit(docs, monkeypatch, ranks, least, block, tile):
    """Also with tiny blocks and tiles, so that every pair is put together from several."""
    monkeypatch.setattr(divergence, "BLOCK_ROWS", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    got = divergence.audit(docs, ranks, least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [(r.lang, r.source, r.text) for r in docs.select("lang", "source", "text").collect()]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, ranks, least)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_audit_of_ties(spark):
    """Many terms of one value: the first in UTF-8 order stay."""
    rows = [("en", s, " ".join(f"{c}{x}" for c in "zaé" for x in "pqrstuv")) for s in ("one", "one", "one")] + [("en", "two", "other words only here")] * 3
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, divergence.audit(frame, 5).collect())) == plain_audit(rows, 5, 3)


def judged(frame, width=5, percent=80):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in tokengroups.similarity_components(frame, width, percent).collect()}


def test_join_edges(spark, docs):
    rows = tokengroups.similarity_components(docs, 3, 85)
    assert rows.columns == ["doc_id", "n_shingles", "component_id"]
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in rows.collect()}
    assert rows.count() == docs.count()
    assert (by[0], by[1], by[2]) == ((0, 0), (0, 1), (0, 2))
    assert (by[4], by[5], by[None]) == ((1, 4), (1, 4), (1, None))
    assert tokengroups.similarity_components(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b c d"), (1, "x y z"), (2, "a b c d"), (3, "x y z")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in tokengroups.similarity_components(twice, 3, 85).collect()) == [(1, 1), (1, 1), (2, 1), (3, 3)]


def test_join_is_exact(spark, monkeypatch):
    """Families near the threshold, a passage in every text, exact copies: against all pairs, with small groups and blocks."""
    monkeypatch.setattr(tokengroups, "MEMBERS", 4)
    monkeypatch.setattr(tokengroups, "BLOCK", 8)
    monkeypatch.setattr(tokengroups, "BUCKET_TOKENS", 2000)
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = [word() for _ in range(30)]
    texts = {}
    for family in range(12):
        base = [word() for _ in range(rng.choice([4, 40, 120]))]
        for _ in range(rng.choice([1, 3, 40])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = word()
            at = rng.randrange(len(own))
            texts[len(texts)] = " ".join([*own[:at], *passage, *own[at:]] if rng.random() < 0.5 else own)
    texts |= {1000 + i: " ".join([*passage, word()]) for i in range(60)}
    frame = spark.createDataFrame([(k, v) for k, v in texts.items()], "doc_id long, text string")
    for width, percent in ((5, 80), (2, 60)):
        assert judged(frame, width, percent) == near_duplicate_classes(texts, width, percent)


def test_bounds_hold():
    """What bitmaps say is missing is missing, at any two sizes."""
    rng = np.random.default_rng(1)
    for n, m in ((1, 5), (100, 130), (900, 800), (40_000, 300)):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: len(a) // 2], rng.integers(0, 1 << 62, m).astype(np.uint64)]))
        one, other = (np.unpackbits(tokengroups.bitmap(x), bitorder="little") for x in (a, b))
        assert len(one) & (len(one) - 1) == 0
        for p, q, x, y in ((tokengroups.bitmap(a), tokengroups.bitmap(b), a, b), (tokengroups.bitmap(b), tokengroups.bitmap(a), b, a)):
            assert tokengroups.lacking(p, q) <= len(np.setdiff1d(x, y))
            more, less = tokengroups._lacks(p, np.array([q]))
            assert (more[0], less[0]) == (tokengroups.lacking(p, q), tokengroups.lacking(q, p))


def test_packed_numbers_come_back():
    for width, top in ((4, 1 << 32), (5, 1 << 40), (6, 1 << 48)):
        numbers = np.random.default_rng(2).integers(0, top, 1000).astype(np.uint64)
        assert (tokengroups.unpack(tokengroups.pack(numbers, width), width) == numbers).all()
