"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_queries import check_sequences
from ticketspark.llm import bpe, chat, hamming, licenses, neardup, packing, quality, sharding, toxicity, urls

LONG = "word " * 60_000 + "x" * 50_000
TEXTS = [None, "", "   \n\t ", "one", "Same text here", "Same text here", "Released under the MIT License.", LONG, "é\x00 \N{EM SPACE}日本語", "a b c " * 40]


@pytest.fixture(scope="module")
def docs(spark):
    """Ids with a null and a repeated row, and columns named as the operators' own."""
    rows = [(None if i == 3 else i, t, "en", "s", 1, 0.5, True, 7, "kept") for i, t in enumerate(TEXTS)]
    rows.append(rows[5])
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, n_words long, shard string"
    )


def test_bpe(spark, docs):
    path, pattern = bpe.default_path(), bpe.default_pattern()
    rows = bpe.decode(bpe.encode(docs, path, pattern, keep=("doc_id", "text")), path).collect()
    assert len(rows) == docs.count()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert bpe.encode(docs.limit(0), path, pattern).count() == 0
    clashing = docs.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(1))
    assert bpe.decode(bpe.encode(clashing, path, pattern, keep=("doc_id", "ids")), path).columns == ["doc_id", "ids", "decoded"]


def test_licenses(docs):
    rows = licenses.scan_licenses(docs, keep=("doc_id", "score", "lang")).collect()
    assert len(rows) == docs.count()
    found = {r.doc_id: r for r in rows}
    assert (found[0].n_words, found[0].labels, found[0].first_word) == (0, "", None)
    assert (found[6].labels, found[6].score, found[7].n_words) == ("mit", 1.0, 60_001)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_near_duplicates(spark, docs):
    rows = neardup.near_duplicates(docs, 3, 85).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[0].component_id, by[0].n_shingles, by[0].kept) == (0, 0, True)
    assert (by[1].component_id, by[2].component_id) == (1, 2)
    assert (by[4].component_id, by[5].component_id, by[5].kept) == (4, 4, False)
    assert (by[None].component_id, by[None].kept) == (None, True)
    assert neardup.near_duplicates(docs.limit(0), 3, 85).count() == 0
    twice = spark.createDataFrame([(1, "a b c d"), (1, "x y z"), (2, "a b c d"), (3, "x y z")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in neardup.near_duplicates(twice, 3, 85).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 3)]


def test_sharding(spark, docs):
    rows = sharding.shard(docs.select("doc_id", "text", "shard"), ["doc_id", "text"], 4).collect()
    assert len(rows) == docs.count()
    sizes = [sum(r.shard == s for r in rows) for s in range(4)]
    assert max(sizes) - min(sizes) <= 1
    assert sorted((r.shard, r.slot) for r in rows) == sorted((s, i) for s, n in enumerate(sizes) for i in range(n))
    assert sharding.shard(docs.limit(0).select("doc_id"), ["doc_id"], 4).count() == 0
    spread = sharding.shard(docs.repartition(7).select("doc_id", "text"), ["doc_id", "text"], 4)
    place = lambda found: sorted(((r.doc_id is not None, r.doc_id), r.shard, r.slot) for r in found)
    assert place(rows) == place(spread.collect())


def test_packing(spark, docs):
    path = packing.default_path()
    pieces = packing.tokenize(docs.withColumn("length", F.lit("x")), path, keep=("doc_id", "length", "lang"), capacity=64)
    rows = packing.pack(pieces, ["doc_id", "start"], capacity=64, group_rows=4).collect()
    check_sequences(rows, 64)
    empty = [r for r in rows if r.doc_id in (0, 1, 2)]
    assert [(r.start, r.length, r.doc_tokens) for r in empty] == [(0, 1, 1)] * 3
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    assert packing.pack(packing.tokenize(docs.limit(0), path), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        packing.pack(pieces, ["doc_id", "start"], capacity=32)


def test_chat(spark):
    schema = "conv_id long, seq long, message long, kind string, role string, text string, formatted string"
    rows = [(1, 0, 0, None, None, None, "x"), (1, 0, 1, "message", "user", "", "x"), (None, 0, 0, "message", "user", LONG, "x"), (1, 0, 1, "message", "user", "", "x")]
    events = spark.createDataFrame(rows, schema)
    found = {r.conv_id: r for r in chat.digest_conversations(chat.format_conversations(events)).collect()}
    assert (found[1].n_turns, found[1].loss_chars, found[None].n_turns) == (2, 0, 1)
    assert found[1].turns_sha256 == hashlib.sha256(b"\n\nuser\n\n").hexdigest()


def test_quality(docs):
    rows = quality.judge(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[0].n_words, by[0].n_lines, by[0].kept) == (0, 0, False)
    assert (by[7].n_words, by[7].n_repeat_words, by[7].word_chars) == (60_001, 60_000, 290_000)
    assert by[9].n_repeat_words == 120
    assert quality.judge(docs.limit(0)).count() == 0
    assert quality.judge(docs, {}).where("kept").count() == docs.count()
    failing = quality.judge(docs, {"null": F.lit(None).cast("boolean"), "all": F.lit(True)})
    assert failing.where("kept").count() == 0


def test_urls(spark):
    given = [None, "", "no scheme", "HTTP://A.Example.ORG/es/x?y", "x://example.org", "http://org/", "http://free-bets.example.com:80/", "http://m.free-bets.example.com/fr/1", "http://m.free-bets.example.com", "http://a.com/fr/" + "z" * 20_000]
    rows = [(i, u, "x", "y") for i, u in enumerate(given)] + [(0, None, "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, _keys string")
    hosts = spark.createDataFrame([(h,) for h in [*urls.BLOCKED_HOSTS, None]], "key string")
    judge = lambda p: urls.judge_urls(p, urls.rule_frame(spark, urls.RULES), hosts, urls.path_lengths(urls.RULES))
    found = {r.page_id: (r.host, r.path[:6], r.rule, r.verdict) for r in judge(pages).collect()}
    assert found[0] == found[1] == found[2] == ("", "", None, "allow")
    assert found[3] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert found[4] == ("example.org", "", None, "allow")
    assert found[5] == ("org", "/", "org/", "allow")
    assert found[6][2:] == (None, "allow")
    assert found[7][2:] == ("com/fr/", "allow")
    assert found[8][2:] == (None, "block")
    assert found[9][2:] == ("com/fr/", "allow")
    assert judge(pages.limit(0)).count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(30_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = universe.where("pmod(xxhash64(key), 97) = 0")
    cascade = urls.build_cascade(listed, universe, 30_000)
    assert len(cascade.levels) > 2
    inside = universe.where(cascade.member(F.col("key")))
    assert inside.exceptAll(listed).count() == 0 and listed.exceptAll(inside).count() == 0
    nothing = urls.build_cascade(listed.limit(0), universe, 30_000)
    assert universe.where(nothing.member(F.col("key"))).count() == 0


def test_toxicity(spark, docs):
    labels = spark.createDataFrame([(0, 1), (4, 0), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.learn_from(docs, labels)
    rows = toxicity.score_texts(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_texts(docs.limit(0), toxicity.learn_from(docs, labels.limit(0))).count() == 0


def test_hamming(spark):
    nan = float("nan")
    rows = [(0, [1.0, -1.0]), (20, None), (40, [1.0]), (60, [None, 0.0]), (1, [nan, 1.0]), (None, [1.0, 1.0]), (2, [1.0, -1.0]), (0, [1.0, -1.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "id long, v array<double>, code string")
    codes = hamming.sign_codes(frame, "id", "v")
    got = {(r.query, r.key, r.distance, r["rank"]) for r in hamming.nearest_codes(codes, F.col("key") % 20 == 0, 2).collect()}
    assert got == {(0, 2, 0, 1), (0, 1, 2, 2), (60, 1, 0, 1), (60, 0, 2, 2)}
    assert hamming.nearest_codes(codes.limit(0), F.lit(True), 2).count() == 0


def test_stages(spark, docs, data):
    before = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, data)
        if name != "packing":
            assert kept.columns == before, name
        assert kept.count() <= 11 * 200
        empty = stage(spark, docs.limit(0), data)
        assert empty.count() == 0
    kept = corpus_pipeline.near_duplicate_filter(spark, docs, data)
    ids = [r.doc_id for r in kept.collect()]
    assert None in ids and 4 in ids and 5 not in ids and len(ids) == len(set(ids))
