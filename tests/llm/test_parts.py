"""The operators' parts against plain versions."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketspark.llm import bpe, chat, hamming, licenses, neardup, packing, sharding, toxicity


@given(st.integers(1, 3000), st.integers(0, 2**63))
@settings(max_examples=40, deadline=None)
def test_permutation(n, seed):
    assert sorted(sharding.permute(np.arange(n), n, seed)) == list(range(n))


def test_locate_needs_no_table():
    placed = sharding.permute(np.arange(1000), 1000, 42)
    assert sharding.locate(123, 1000, 16) == (placed[123] % 16, placed[123] // 16)


@given(st.lists(st.integers(1, 50), max_size=80))
@settings(max_examples=80, deadline=None)
def test_first_fit_decreasing(lengths):
    bins, offsets = packing.first_fit_decreasing(lengths, 50)
    used = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((k for k, u in enumerate(used) if u + lengths[i] <= 50), len(used))
        if b == len(used):
            used.append(0)
        assert (bins[i], offsets[i]) == (b, used[b])
        used[b] += lengths[i]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", ""]), st.text(alphabet="\\<|>n\nturn endé#", max_size=12)), max_size=5))
@settings(max_examples=200, deadline=None)
def test_chat_round_trip(turns):
    text, spans = chat.render_turns(turns)
    assert chat.parse_turns(text) == turns
    learned = "".join(chat.unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True))
    assert learned == "".join(t for role, t in turns if role == "assistant")
    assert text.count(chat.OPEN) == text.count(chat.CLOSE) == len(turns)


def test_fold_events(spark):
    log = [
        (1, 0, 1, "message", "user", "hello"),
        (1, 1, 2, "message", "assistant", None),
        (1, 2, 2, "delta", None, "wro"),
        (1, 3, 2, "regenerate", None, None),
        (1, 4, 2, "delta", None, "ri"),
        (1, 5, 2, "delta", None, "ght"),
        (1, 6, 1, "edit", None, "hi"),
        (1, 7, 3, None, "user", "gone"),
        (1, 8, 3, "delete", None, None),
        (2, 0, 1, "delta", None, "alone"),
    ]
    schema = "conv_id long, seq long, message long, kind string, role string, text string"
    events = spark.createDataFrame(random.Random(1).sample(log, len(log)), schema)
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold_messages(events).collect()}
    assert got == {(1, 1): ("user", "hi"), (1, 2): ("assistant", "right"), (2, 1): ("", "alone")}
    formatted = {r.conv_id: r.formatted for r in chat.format_conversations(events).collect()}
    assert chat.parse_turns(formatted[1]) == [("user", "hi"), ("assistant", "right")]
    assert chat.format_conversations(events.limit(0)).count() == 0


def test_fold_against_plain_states(spark):
    """Random logs, against a state changed event by event."""
    rng = random.Random(5)
    kinds = ["message", "delta", "delta", "delta", "edit", "regenerate", "delete", None, "other"]
    log, wanted = [], {}
    for message in range(150):
        role, parts, gone = "", [], False
        for seq in range(rng.randint(1, 12)):
            kind, who, text = rng.choice(kinds), rng.choice([None, None, "user", "assistant"]), rng.choice([None, "a", "b ", "\n", "\U0001f600"])
            log.append((message % 7, seq, message, kind, who, text))
            role, gone = who or role, kind == "delete"
            if kind == "delta":
                parts.append(text or "")
            else:
                parts = [] if kind in ("regenerate", "delete") else [text or ""]
        if not gone:
            wanted[message] = role, "".join(parts)
    rng.shuffle(log)
    events = spark.createDataFrame(log, "conv_id long, seq long, message long, kind string, role string, text string")
    assert {r.message: (r.role, r.text) for r in chat.fold_messages(events).collect()} == wanted


def test_long_streams_are_folded_once(spark):
    from pyspark.sql import functions as F

    events = spark.range(200_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("seq"), F.lit(1).alias("message"), F.lit("delta").alias("kind"),
        F.lit("assistant").alias("role"), F.concat(F.col("id").cast("string"), F.lit(" ")).alias("text"),
    )
    row = chat.fold_messages(events).first()
    assert row.text == "".join(f"{i} " for i in range(200_000))


def test_event_log_folds_to_its_rows(spark):
    rows = [(1, 1, "user", "hi"), (1, 2, "assistant", "\U0001f600 " * 300), (1, 3, None, "x"), (1, 4, "assistant", None), (2, 1, "system", ""), (3, 1, "user", None)]
    events = chat.event_log(spark.createDataFrame(rows, "conv_id long, message long, role string, text string"))
    kinds = {r.kind for r in events.select("kind").distinct().collect()}
    assert kinds == {"message", "delta", "edit", "regenerate", "delete"}
    got = {(r.conv_id, r.message, r.role, r.text) for r in chat.fold_messages(events).collect()}
    # an edit without a text leaves an empty one
    assert got == {(c, m, role or "", text or "") for c, m, role, text in rows}


def test_template_markup():
    a = licenses.compile_template("x", "Licensed <<beginOptional>>(c) <<var;1;2>> <<endOptional>>under <<var;2;3>> terms")
    plain = re.compile(r"licensed (?:c (?:\S+ ){1,2})?under (?:\S+ ){2,3}terms(?= )")
    rng = random.Random(3)
    for _ in range(3000):
        words = [rng.choice(["licensed", "c", "under", "terms", "a", "b"]) for _ in range(rng.randint(0, 12))]
        text = " ".join(words) + " "
        wanted = sorted({text[: m.start()].count(" ") for i in range(len(text)) if (i == 0 or text[i - 1] == " ") and (m := plain.match(text, i))})
        assert [s for s, _ in a.find([w.encode() for w in words])] == wanted
    assert licenses.make_scanner().scan("Released under the\nMIT-License!".encode())[2] == [("mit", 0, 5)]
    assert licenses.make_scanner().scan(b"released under our MIT license")[2] == []
    for bad in ("<<beginOptional>> x", "x <<what>>", "<<var;1;2>>"):
        with pytest.raises(ValueError):
            licenses.compile_template("x", bad)


def test_words_of_odd_texts():
    import tiktoken

    plain = tiktoken.Encoding("plain", pat_str=bpe.default_pattern(), mergeable_ranks=bpe.read_ranks(bpe.default_path()), special_tokens={})
    rng = random.Random(5)
    parts = [" ", "\n", "\t", "'", "s", "re", "a", "1", "!", "\xa0", "\x1c", "é", "ll", "\r", "\x85", "²", "\N{EM SPACE}", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    words, coded = bpe.index_words(texts, bpe._splitter(bpe.default_pattern()))
    for text, numbers in zip(texts, coded, strict=True):
        assert "".join(words[i] for i in numbers) == text
        assert [t for i in numbers for t in plain.encode_ordinary(words[i])] == plain.encode_ordinary(text)


def test_vocabulary_of_odd_texts():
    from tokenizers import Tokenizer

    path = packing.default_path()
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    own = packing.Vocabulary(path)
    rng = random.Random(6)
    parts = ["a", "É", "ß", "İ", "Σ", " ", "\n", "\t", ".", ",", "...", "'s", "1", "ll", "\N{COMBINING ACUTE ACCENT}", "<|endoftext|>", "\xa0", "À", "×", "\x1c"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(900, i) for i in range(500, 900)]
    root = {x: x for e in edges for x in e}
    for _ in range(500):
        before = dict(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    got = {r.key: r.label for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if k != v}


def test_large_nodes_branch(spark, monkeypatch):
    """Nodes over the limits give the same components."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(words) for _ in range(60)] for _ in range(3)]
    rows = []
    for i in range(240):
        text = list(bases[i % 3])
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(60)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    from tests.llm.test_queries import near_duplicate_classes

    wanted = near_duplicate_classes(dict(rows), 3, 85)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(neardup, "NODE_WORK", 300)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 3, 85, trees=3).collect()}
    wrong = [k for k, (_, c) in wanted.items() if got[k] != c]
    assert len(wrong) <= 2, wrong


def test_near_duplicates_of_nodes_that_become_small(spark, monkeypatch):
    """The links of 1 to 4 bring the node of all six under the limit after its round's pass; 5 and 6 meet only there."""
    words = [f"w{i}" for i in range(100)]
    other = [f"v{i}" for i in range(100)]
    third = [*words[8:], *[f"t{i}" for i in range(8)]]
    lists = [[*words[:-1], "one"], words, [*third[:-1], "two"], third, other, [*other[:-1], "three"]]
    docs = spark.createDataFrame([(i + 1, " ".join(x)) for i, x in enumerate(lists)], "doc_id long, text string")
    places = [(1, k) for k in range(1, 7)] + [(2, k) for k in range(1, 5)]
    monkeypatch.setattr(neardup, "_first_paths", lambda classes, trees: spark.createDataFrame(places, "path long, key long"))
    run = lambda: {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 1, 80).collect()}
    unlimited = run()
    monkeypatch.setattr(neardup, "NODE_WORK", 12)
    assert run() == unlimited == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5}


def test_trees_follow_from_the_threshold(spark, monkeypatch):
    """Simulated tokens of pairs at 0.8 and 0.85, and what near_duplicates asks for."""
    rng = np.random.default_rng(3)
    for percent in (80, 85):
        trees = neardup.trees_for(percent)
        one = rng.integers(0, 1 << 16, (20_000, neardup.COORDINATES)).astype(np.uint16)
        two = np.where(rng.random(one.shape) < percent / 100, one, one + np.uint16(1))
        roots = np.tile(neardup._mix(np.arange(1, trees + 1, dtype=np.uint64)), (len(one), 1))
        a, b = (np.sort(neardup.descend(roots, x, neardup.DEPTH), axis=1) for x in (one, two))
        apart = sum(not np.intersect1d(x, y).size for x, y in zip(a, b, strict=True))
        assert apart <= 1.5 * neardup.MISSED * len(one)
        assert apart == pytest.approx(neardup.missed(percent, trees) * len(one), abs=12)
    asked = []
    first = neardup._first_paths
    monkeypatch.setattr(neardup, "_first_paths", lambda classes, trees: asked.append(trees) or first(classes, trees))
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    neardup.near_duplicates(docs)
    neardup.near_duplicates(docs, trees=2)
    assert asked == [neardup.trees_for(80), 2] and asked[0] >= 3
    with pytest.raises(ValueError):
        neardup.trees_for(5)


@pytest.mark.parametrize("bits", [16, 40])
def test_nearest_codes(spark, bits, monkeypatch):
    monkeypatch.setattr(hamming, "BLOCK_CODES", 64)
    monkeypatch.setattr(hamming, "PACK_QUERIES", 4)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, bits))
    vectors[100:200] = vectors[7]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    codes = hamming.sign_codes(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v")
    from pyspark.sql import functions as F

    got = hamming.nearest_codes(codes, F.col("key") % 20 == 0, 5).collect()
    signs = vectors >= 0
    wanted = set()
    for q in range(0, 300, 20):
        order = sorted((int((signs[q] != signs[i]).sum()), i) for i in range(300) if i != q)[:5]
        wanted |= {(q, i, d, r + 1) for r, (d, i) in enumerate(order)}
    assert {tuple(r) for r in got} == wanted


def test_nearest_codes_of_several_lengths(spark, monkeypatch):
    """Every length is searched for itself: odd vectors neither hide the others nor answer for them."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(hamming, "BLOCK_CODES", 16)
    rng = np.random.default_rng(4)
    sizes = [64] * 60 + [65] + [17] * 30 + [0]
    vectors = [rng.normal(size=n).tolist() for n in sizes]
    frame = spark.createDataFrame([*enumerate(vectors), (200, None)], "id long, v array<double>").coalesce(1)
    got = hamming.nearest_codes(hamming.sign_codes(frame, "id", "v"), F.col("key") % 20 == 0, 3).collect()
    wanted = set()
    for q in range(0, len(sizes), 20):
        away = lambda i: sum((a >= 0) != (b >= 0) for a, b in zip(vectors[q], vectors[i], strict=True))  # noqa: E731, B023
        near = sorted((away(i), i) for i in range(len(sizes)) if i != q and sizes[i] == sizes[q])[:3]
        wanted |= {(q, i, d, r + 1) for r, (d, i) in enumerate(near)}
    assert {tuple(r) for r in got} == wanted
    assert {r.query for r in got} == {0, 20, 40, 80}  # 60 is alone in its length


def test_toxicity_without_both_labels():
    model = toxicity.fit([b"only"], [], 0.5)
    assert 0 <= model.score(None, b"any text") <= 1


def _toxic_rows(before):
    """Ordinary texts, and toxic ones that differ in a word behind ``before`` ordinary words."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(400)]
    prose = lambda: " ".join(rng.choice(words, before))
    rude = ["zuxqwork", "xqwyzzle", "qwuzzkin"]
    return [(i, f"{prose()} {rude[i % 3]}", 1) if i % 3 == 0 else (i, prose(), 0) for i in range(300)]


def _learned(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.learn(frame.select("doc_id", "toxic"), frame.select("doc_id", "text"))


def test_toxicity_learns_from_whole_texts(spark):
    rows = _toxic_rows(1500)
    assert min(len(t) for _, t, _ in rows) > 10_000
    model = _learned(spark, rows)
    costs = toxicity.Costs(model.toxic, model.ordinary) if model.toxic else None
    assert all((model.score(costs, t.encode()) >= 0.7) == bool(label) for _, t, label in rows)


def test_toxicity_of_a_table_equals_that_of_lists(spark):
    rows = [*_toxic_rows(40), (1000, "ab", 0), (1001, "ab", 1), (1002, "", 0)]
    pick = lambda value: [t.encode() for _, t, label in rows if label == value]
    one, two = _learned(spark, rows), toxicity.fit(pick(1), pick(0), sum(r[2] for r in rows) / len(rows))
    assert one.toxic and (one.toxic, one.ordinary) == (two.toxic, two.ordinary)
    assert one.weights == pytest.approx(two.weights)


def test_toxicity_learns_one_text_of_a_key(spark, monkeypatch):
    """However many rows a chosen key has."""
    held = []
    monkeypatch.setattr(toxicity, "_fit", lambda sample, prior: held.append(sample.sizes))
    rows = _toxic_rows(5)[:4] + [(0, f"other text {i}", 1) for i in range(200)]
    _learned(spark, rows)
    assert held == [(2, 2)]


def test_worker_keeps_helpers_of_one_operator():
    from ticketspark.llm import worker

    first = worker.held("one", "a", list)
    assert worker.held("one", "a", list) is first and worker.held("one", "b", dict) == {}
    worker.held("two", "a", dict)
    assert worker.held("one", "a", list) is not first
    worker.only("three")
    assert not worker._HELD


def test_vocabulary_is_bounded_by_bytes(monkeypatch):
    own = packing.Vocabulary(packing.default_path())
    text = " ".join(f"w{i}ord" for i in range(400))
    wanted = own.encode(text)
    monkeypatch.setattr(packing, "REMEMBERED", 250_000)
    small = packing.Vocabulary(packing.default_path())
    assert small.encode(text) == wanted and small.encode("x" * 5000 + " end") == own.encode("x" * 5000 + " end")
    monkeypatch.setattr(packing, "REMEMBERED", 20_000)
    assert small.encode(text) == wanted and small._bytes <= 250_000


def test_vocabulary_keeps_frequent_pieces(monkeypatch):
    """A piece that comes again and again is merged once, however many others pass; spellings share its merges."""
    monkeypatch.setattr(packing, "REMEMBERED", 400_000)
    own, merged = packing.Vocabulary(packing.default_path()), []
    merge = own._merge
    own._merge = lambda word: merged.append(word) or merge(word)
    rng = random.Random(9)
    fresh = ["".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(4000)]
    for word in fresh:
        own.encode(f"Often {word.capitalize()}, often.")
    assert merged.count("often") == 1 and len(merged) == 1 + len(set(fresh))
    assert own._bytes <= 200_000 and len(own) + len(own._older) < 2000


def test_vocabulary_of_many_texts(monkeypatch):
    """All texts of an array at once, by any block: what each gives alone, and each piece is looked up once."""
    import pyarrow as pa

    own = packing.Vocabulary(packing.default_path())
    rng = random.Random(10)
    parts = ["a", "Word,", "word", "É.", "ß", "İ", " ", "\n", "\t", "...", "'s", "1", "語", "", "x" * 90]
    texts = [None, "", " ", *(" ".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(300)), None]
    wanted = [own.encode(t or "") for t in texts]
    for block in (1, 200, 1 << 20):
        monkeypatch.setattr(packing, "TOGETHER", block)
        assert list(own.encode_all(pa.array(texts))) == wanted
        assert list(own.encode_all(pa.array(texts).slice(7, 100))) == wanted[7:107]
    assert list(own.encode_all(pa.array([], pa.string()))) == []
    asked = []
    own._tokenizer = type("Whole", (), {"encode": lambda _, piece, tok=own._tokenizer, **kw: asked.append(piece) or tok.encode(piece, **kw)})()
    long = "".join(rng.choice("語文字") for _ in range(20_000))  # too long to be remembered
    assert len(set(own.encode_all(pa.array([long] * 3)))) == 1 and asked == [long]


def test_vocabulary_splits_words_from_marks():
    """Any mix of Latin letters, digits and marks: the whole tokenizer's ids, by itself and among others."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = packing.default_path()
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    own = packing.Vocabulary(path)
    rng = random.Random(12)
    parts = ["Word", "é", "SS", "ß", "ÿ", "Øre", "a", "'", "'s", "'LL", "d", *"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", "7", "42", "\x7f", "\x00", "×", "º", "µ", "ſ", "K", "²", "H\u0331", "\u0301", " ", "\t", "w" * 70, "É" * 33]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    wanted = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for encoded in (map(own.encode, texts), own.encode_all(pa.array(texts)), own.encode_all(pa.array(texts, pa.large_string()))):
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoded] == wanted


def test_vocabulary_takes_marks_from_words():
    """Marks after a word or between words need only the words' merges, once a word, not the whole tokenizer for each piece."""
    import pyarrow as pa

    own = packing.Vocabulary(packing.default_path())
    asked, merged, merge, whole = [], [], own._merge, own._tokenizer
    own._merge = lambda word: merged.append(word) or merge(word)
    own._tokenizer = type("Whole", (), {"encode": lambda _, piece, **kw: asked.append(piece) or whole.encode(piece, **kw)})()
    text = "Word*** word### WORD.&&& word), (word) word-word's Straße... STRASSE'"
    for _ in range(2):
        (ids,) = own.encode_all(pa.array([text]))
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(set(merged)) == 3 and len(merged) <= 4 and {"strasse", "word"} < set(merged)
    assert not [piece for piece in asked if any(c.isalpha() for c in piece) and "'" not in piece]


def test_vocabulary_table_is_bounded_and_keeps_frequent_words(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "TABLE", 40_000)
    monkeypatch.setattr(packing, "FEW", 1000)
    own, merged = packing.Vocabulary(packing.default_path()), []
    merge, rng = own._merge, random.Random(13)
    own._merge = lambda word: merged.append(word) or merge(word)
    fresh = ["".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(4000)]
    for at in range(0, 4000, 100):
        list(own.encode_all(pa.array([f"Often {word}, often." for word in fresh[at : at + 100]])))
        assert sum(x.nbytes for x in own._table) <= 40_000
    assert merged.count("often") == 1 and len(merged) == 1 + len(set(fresh))
    table = own._table
    monkeypatch.setattr(packing, "FEW", 8)
    few = [f"Some {fresh[0]}. few, words"]
    assert [*own.encode_all(pa.array(few))] == [packing.Vocabulary(packing.default_path()).encode(few[0])] and own._table is table
    monkeypatch.setattr(packing, "FEW", 1000)
    monkeypatch.setattr(packing, "TABLE", 0)
    assert [*own.encode_all(pa.array(["often a"]))] == [own.encode("often a")] and len(own._table[0]) == 0


def test_whole_licence_texts(spark):
    """Every wording of a template is accepted whole; openings, altered, added and missing words are not."""
    import re

    scanner = licenses.make_scanner()
    rng = random.Random(7)

    def wording(template):
        out, optional = [], []
        for k, piece in enumerate(re.split(r"<<(.*?)>>", template)):
            if k % 2 == 0:
                words = piece.split()
                out += words if all(optional) else []
            elif piece == "beginOptional":
                optional.append(rng.random() < 0.5)
            elif piece == "endOptional":
                optional.pop()
            elif all(optional):
                least, most = map(int, piece.split(";")[1:])
                out += ["Acme"] * rng.randint(least, most)
        return out

    def found(words):
        text = " ".join(words)
        labels = {label for label, _, _ in scanner.scan(text.encode())[2]}
        clean = " " + " ".join(licenses.normalised(text.encode()).decode().split()) + " "
        assert labels == {label for label, t in licenses.TEMPLATES if re.search(" " + licenses.as_regex(t), clean)}
        return labels

    named = {label for label, _ in licenses.NOTICES}
    for label, template in licenses.TEXTS:
        for _ in range(6):
            words = wording(template)
            assert label in found(["Copyright", "2020", *words, "end"])
            half = words[: len(words) // 2]
            assert found(half) <= named - {"mit"}
            for _ in range(4):
                # these words are mandatory wherever they stand
                at = rng.choice([i for i, w in enumerate(words) if w.strip(".,;:()").lower() in ("provided", "without", "subject", "conditions")])
                assert label not in found([*words[: at + 1], "except", "that", "commercial", "use", "resale", "and", "military", "use", "are", "forbidden", *words[at + 1 :]])
                assert label not in found(words[:at] + words[at + 1 :])
            assert label not in found(words[:-3])  # a replaceable region may end the text
    stump = b"Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction except that military use is forbidden"
    assert scanner.scan(stump)[2] == []
    whole = " ".join(wording(dict(licenses.TEXTS)["mit"]))
    docs = spark.createDataFrame([(1, whole), (2, stump.decode()), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(docs).collect()}
    assert got == {1: ("mit", 1.0), 2: ("", 0.0), 3: ("", 0.0)}


def test_quality_cascade_stops_at_the_first_rejection(spark, data):
    from pyspark.sql import functions as F

    from ticketspark.llm import quality

    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (-3, "a b " * 40), (-4, "#$ " * 60), (-5, "x\n" * 80), (-6, "y" * 5000 + " ab" * 3), (-7, " ".join(map(str, range(60))))]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    whole = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    lazy = quality.passed(docs)
    assert {r.doc_id for r in lazy.collect()} == whole and not whole & {-1, -2, -3, -4, -5, -6}
    # the text is split into words once
    one = quality.passed(spark.read.parquet(f"{data}/documents.parquet"))
    assert one._jdf.queryExecution().optimizedPlan().toString().count(quality.SPACE + ", -1") == 1
    # a rule behind another one never sees what that one rejects
    rules = {
        "short": lambda t, w: F.size(w) < 50,
        "late": lambda t, w: F.when(F.size(w) < 50, F.raise_error(F.lit("was asked"))).otherwise(F.lit(False)).cast("boolean"),
    }
    kept = docs.where(quality.verdict(F.col("text"), rules, ["short", "late"]))
    assert kept.count() == docs.where(F.size(quality.words(F.coalesce("text", F.lit("")))) >= 50).count()
    with pytest.raises(Exception, match="was asked"):
        docs.where(quality.verdict(F.col("text"), rules, ["late", "short"])).count()
    assert quality.passed(docs.limit(0)).count() == 0
