"""Packing token sequences of one length: first-fit decreasing with a tournament tree of free space.

A document's tokens are cut into full sequences and one rest. Full sequences need no search. Rests
are dealt into groups by a hash of their id, each group is sorted by falling length, and every rest
goes into the first open sequence that has room for it. A tournament tree holds the largest free
space below every node, so that sequence is found in logarithmic time.

Groups are independent: a group's size is bounded by the number of groups, whatever the keys, and a
lost task packs the same rests again into the same sequences.
"""

from __future__ import annotations

import itertools
import operator
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import in_small_batches, materialize
from .registry import query, table, without
from .worker import held

LENGTH = 4096
#: Rests that a group holds on average. Padding hardly falls beyond a few thousand.
GROUP_ROWS = 8192
END_ID = 2
#: Bytes of the pieces and ids that a worker remembers, and what each entry takes beside them.
REMEMBERED, ENTRY = 32 << 20, 200
#: Bytes of the table of words that a worker remembers, and of the longest word in it. A lookup reads the
#: whole table, so few words are not looked up in one of more than ``FEW`` times as many.
TABLE, LONGEST, FEW = 10 << 20, 64, 8
#: Bytes of texts whose pieces are made distinct together; a longer text is taken alone.
TOGETHER = 4 << 20
_ID = operator.attrgetter("id")
_LETTERS, _MARKS = r"A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF", r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(rf"[{_LETTERS}0-9{_MARKS}]+").fullmatch
_WORDS = re.compile(rf"[{_LETTERS}]+|[0-9]|[{_MARKS}]+").findall
#: A word and the marks after it. No letter follows them, so an apostrophe is a mark too.
_MARKED = rf"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[{_MARKS}']*)$"


def first_fit_decreasing(lengths: Sequence[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items of equal length go in the given order.

    Lengths must lie in 0..capacity. Bins are numbered from 0 in the order they are opened.
    """
    n = len(lengths)
    size = 1
    while size < max(n, 1):
        size *= 2
    free = [capacity] * (2 * size)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for item in np.argsort(-np.asarray(lengths, dtype=np.int64), kind="stable").tolist():
        need = int(lengths[item])
        node = 1
        while node < size:
            node *= 2
            if free[node] < need:
                node += 1
        bins[item], offsets[item] = node - size, capacity - free[node]
        free[node] -= need
        node //= 2
        while node:
            left, right = free[2 * node], free[2 * node + 1]
            most = left if left > right else right
            if free[node] == most:
                break
            free[node] = most
            node //= 2
    return bins, offsets


def pack(pieces: DataFrame, key: Sequence[str], length: str = "length", capacity: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` with sequence_id and offset. Runs the job that counts them.

    A piece longer than ``capacity`` or without tokens is an error; null lengths too. ``key`` names
    columns that tell pieces apart; their hash breaks ties, and with a row's place in the written table
    it chooses the group, so repeated rows spread over all groups. Full pieces have negative sequence
    ids. Only the columns of ``pieces`` move, once; keep them narrow. An empty table stays empty. Columns
    named as the added ones, ``_group`` or ``_order`` are left out.
    """
    pieces = without(pieces, ["sequence_id", "offset", "_group", "_order"], [*key, length])
    written = materialize(pieces, "pieces")
    n, bad = written.agg(
        F.count_if(F.col(length) < capacity), F.count_if(F.col(length).isNull() | (F.col(length) < 1) | (F.col(length) > capacity))
    ).first()
    if bad:
        raise ValueError(f"{bad} pieces have lengths outside 1..{capacity}")
    groups = max(1, -(-n // group_rows))
    order = F.xxhash64(*[F.col(k) for k in key], F.lit(7))
    full = written.where(F.col(length) == capacity).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )
    rests = written.where(F.col(length) < capacity).withColumns(
        {"_order": order, "_group": F.pmod(F.xxhash64(order, F.monotonically_increasing_id()), F.lit(groups))}
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_order", *key], kind="stable", ignore_index=True)
        bins, offsets = first_fit_decreasing(pdf[length].to_numpy(), capacity)
        group = int(pdf["_group"].iloc[0])
        # a group opens at most 2**31 sequences, so numbers of different groups do not meet
        return pdf.drop(columns=["_order", "_group"]).assign(sequence_id=(group << 31) + bins, offset=offsets)

    placed = rests.groupBy("_group").applyInPandas(place, f"{schema}, sequence_id long, offset long")
    return full.unionByName(placed)


def _runs(values: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values`` holds runs of the given lengths: those that ``which`` numbers, in its order, and their lengths."""
    n = lengths[which].astype(np.int64)
    place = np.repeat((np.cumsum(lengths, dtype=np.int64) - lengths)[which] - (np.cumsum(n) - n), n)
    place += np.arange(len(place))
    return values[place], n


class Vocabulary(dict):
    """Token ids of a piece of text between spaces, as little-endian 32-bit integers, found when first asked for.

    No token of this tokenizer reaches over white space and its normalisation does not either, so a
    text's ids are those of its pieces in order. A piece of Latin letters, digits and ASCII marks but
    the apostrophe is split as the tokenizer would, into runs of letters, runs of marks and single
    digits, and what is remembered are these; of letters only the merges are run, for their lower case.
    All other pieces go through the whole tokenizer.

    Half of what is remembered is of late: when that half is full it becomes the older half, whose
    pieces come back when they are asked for again. So frequent pieces stay, whatever else passes.
    Of many texts, words with or without marks after them are most pieces: these words are looked up
    all at once, in a table of their own that is several times smaller than a dict of as many words.
    """

    def __init__(self, path: str):
        super().__init__()
        self._bytes, self._older = 0, {}
        self._blocks, self._table = 0, (pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int32), np.zeros(0, np.int32))
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._merge = self._tokenizer.model.tokenize
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._letters = {i: spell(chr(i))[0][0] for i in range(0xC0, 0x100)}

    def __missing__(self, piece: str) -> bytes:
        found = self._older.get(piece)
        if found is None:
            words = _WORDS(piece.lower()) if _PLAIN(piece) else [piece]
            if words != [piece]:
                return b"".join(map(self.__getitem__, words))
            if piece.isalpha() and _PLAIN(piece):
                found = self._merged(piece).tobytes()
            else:
                found = array("I", self._tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        return self._remember(piece, found)

    def _merged(self, word: str) -> array:
        """Ids of a lower-case word of Latin letters."""
        return array("I", map(_ID, self._merge(word if word.isascii() else word.translate(self._letters))))

    def _remember(self, piece: str, found: bytes) -> bytes:
        size = ENTRY + 2 * len(piece) + len(found)
        if size <= REMEMBERED // 1024:  # long pieces seldom come again
            if self._bytes + size > REMEMBERED // 2:
                self._older, self._bytes = dict(self), 0
                self.clear()
            self[piece] = found
            self._bytes += size
        return found

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of each text; a null text is empty. Each distinct word of ``TOGETHER`` bytes of texts is looked up once."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOGETHER, side="right")))
            yield from self._block(texts.slice(at, until - at))
            at = until

    def _block(self, texts: pa.Array) -> Iterator[bytes]:
        pieces = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        encoded = pieces.flatten().dictionary_encode()
        ids, n = _runs(*self._distinct(encoded.dictionary), encoded.indices.to_numpy())
        ids = ids.tobytes()
        before = np.concatenate([[0], np.cumsum(n)])
        bounds = (4 * before[np.concatenate([[0], np.cumsum(pc.list_value_length(pieces).to_numpy())])]).tolist()
        for a, b in itertools.pairwise(bounds):
            yield ids[a:b]

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and how many each has.

        Words are told from the marks after them and lower-cased for all pieces at once.
        """
        word, marks = pc.extract_regex(pieces, _MARKED).flatten()
        marked = pc.less_equal(pc.binary_length(word), LONGEST).fill_null(False)
        words = pc.utf8_lower(word.filter(marked)).dictionary_encode()
        marks = marks.filter(marked).dictionary_encode()
        ids, n = self._words(words.dictionary.cast(pa.string()))
        others = pieces.filter(pc.invert(marked))
        found = list(map(self.__getitem__, [*marks.dictionary.to_pylist(), *others.to_pylist(), ""]))
        # each piece is two of these: a word and its marks, or the piece itself and nothing
        nothing = len(n) + len(found) - 1
        which = np.full((len(pieces), 2), nothing)
        marked = marked.to_numpy(zero_copy_only=False)
        which[marked, 0] = words.indices.to_numpy()
        which[marked, 1] = marks.indices.to_numpy() + len(n)
        which[~marked, 0] = np.arange(nothing - len(others), nothing)
        n = np.concatenate([n, np.fromiter(map(len, found), np.int64, len(found)) // 4])
        ids, n = _runs(np.concatenate([ids, np.frombuffer(b"".join(found), "<u4")]), n, which.ravel())
        return ids, n.reshape(-1, 2).sum(axis=1)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct lower-case words of Latin letters, one after the other, and how many each has.

        The words are looked up all at once in a table of those met before; when it is full, the half last asked for stays.
        """
        known, ids, n, used = self._table
        if len(known) > FEW * len(words):
            found = list(map(self.__getitem__, words.to_pylist()))
            return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = pc.index_in(words, value_set=known)
        fresh = words.filter(at.is_null())
        merged = list(map(self._merged, fresh.to_pylist()))
        where = at.fill_null(-1).to_numpy().astype(np.int64)
        where[where < 0] = len(known) + np.arange(len(fresh))
        known = pa.concat_arrays([known, fresh])
        ids = np.concatenate([ids, np.frombuffer(b"".join(merged), "<u4")])
        n = np.concatenate([n, np.fromiter(map(len, merged), np.int32, len(merged))])
        used = np.concatenate([used, np.zeros(len(fresh), np.int32)])
        self._blocks += 1
        used[where] = self._blocks
        found = _runs(ids, n, where)
        while len(used) and known.nbytes + ids.nbytes + n.nbytes + used.nbytes > TABLE:
            stay = np.sort(np.argsort(used, kind="stable")[(len(used) + 1) // 2 :])
            ids, n = _runs(ids, n, stay)
            known, used = known.take(pa.array(stay)), used[stay]
        self._table = known, ids, n, used
        return found


def _vocabulary(path: str) -> Vocabulary:
    """A worker's vocabulary, kept from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return held("packing", path, lambda: Vocabulary(path))


def tokenize(
    df: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",), capacity: int = LENGTH, with_ids: bool = True
) -> DataFrame:
    """Pieces of every whole text: the ``keep`` columns, start, length, ids_crc32, doc_tokens and, if wanted, ids.

    A text's tokens are those of the tokenizer in ``path`` without special ones, then ``END_ID``; a
    null text is empty and has that one token. Pieces are ``capacity`` tokens long but for the last.
    ``ids`` is binary, little-endian unsigned 32-bit integers. ``keep`` columns named as an added one are
    left out. Nothing is shuffled.
    """
    added = ["start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    keep = [c for c in keep if c.lower() not in added]
    end = np.array([END_ID], dtype="<u4").tobytes()
    step = 4 * capacity

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            at, out = [], []
            for i, ids in enumerate(vocabulary.encode_all(batch.column(len(keep)))):
                ids += end
                for k in range(0, len(ids), step):
                    piece = ids[k : k + step]
                    at.append(i)
                    out.append((k // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, *[piece] * with_ids))
            kept = [c.take(pa.array(at, pa.int32())) for c in batch.columns[: len(keep)]]
            kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids
            columns = [pa.array([row[j] for row in out], kind) for j, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*keep, *added])

    kept = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return in_small_batches(df).select(*[df[c] for c in keep], df[text].alias("_text")).mapInArrow(
        rows, kept + "start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    )


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_packing")
def op5(spark, sf_dir):
    """All documents cut and packed. A rest is told apart by its document and place."""
    pieces = tokenize(table(spark, sf_dir, "documents"), default_path(), with_ids=False)
    return pack(pieces, ["doc_id", "start", "ids_crc32"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
