"""Byte-level BPE by one global shuffle of distinct words.

1. Texts are split into pre-tokens (the words of byte-level BPE), block by block. A block is a bounded
   number of characters. Its distinct words are numbered by falling frequency, and each text becomes
   the list of its words' numbers: a word's positions, without the word.
2. The block's words are dealt into buckets by their hash and shuffled. Every word of the corpus has
   one bucket, where it is encoded once. A word comes at most once from a block and a block's words
   spread over all buckets, so frequent words make no bucket larger than another.
3. The ids go back to the block, where they are joined to the positions and each text's ids stand in
   order.

Decoding joins ids with the token-byte table. That table is as large as the vocabulary, whatever the
corpus, so the join is made where the ids lie.

Ids are kept as binary: little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table, without

#: Characters of a block. One longer text is a block of its own.
BLOCK_CHARS = 8_000_000
#: Rows that are decoded and digested at once.
ROWS_AT_ONCE = 500
#: White space in the sense of the split pattern.
_SPACE = (
    " \t-\r\x85\xa0\N{OGHAM SPACE MARK}\N{EN QUAD}-\N{HAIR SPACE}\N{LINE SEPARATOR}\N{PARAGRAPH SEPARATOR}"
    "\N{NARROW NO-BREAK SPACE}\N{MEDIUM MATHEMATICAL SPACE}\N{IDEOGRAPHIC SPACE}"
)
#: No pre-token has white space after anything else, so texts may be cut before every run of it.
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")

_READY: dict[tuple[str, str], object] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids, out of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in lines if line.strip())}


def _encoder(path: str, pattern: str):
    if ("encoder", path) not in _READY:
        import tiktoken

        _READY["encoder", path] = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    return _READY["encoder", path]


def _token_bytes(path: str) -> dict[int, bytes]:
    if ("bytes", path) not in _READY:
        _READY["bytes", path] = {i: word for word, i in read_ranks(path).items()}
    return _READY["bytes", path]


def _splitter(pattern: str):
    import regex

    return regex.compile(pattern).findall


def _pack(*parts: bytes) -> bytes:
    lengths = np.array([len(p) for p in parts], dtype="<u4").tobytes()
    return zstandard.ZstdCompressor(level=6).compress(lengths + b"".join(parts))


def _unpack(packed: bytes, n: int) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    lengths = np.frombuffer(raw, "<u4", n).tolist()
    out, at = [], 4 * n
    for size in lengths:
        out.append(raw[at : at + size])
        at += size
    return out


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest bytes, then all next ones; frequent words leave the others zero."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def index_words(texts: Sequence[str], split) -> tuple[list[str], list[np.ndarray]]:
    """The distinct words of a block by falling frequency, and each text as the numbers of its words."""
    numbers: dict[str, int] = {}
    known: dict[str, bytes] = {}
    coded = []
    for text in texts:
        chunks = _CHUNK.findall(text)
        for chunk in set(chunks).difference(known):
            known[chunk] = np.array([numbers.setdefault(w, len(numbers)) for w in split(chunk)], dtype="<u4").tobytes()
        coded.append(np.frombuffer(b"".join(map(known.__getitem__, chunks)), "<u4"))
    counts = np.bincount(np.concatenate([*coded, np.zeros(0, "<u4")]).astype(np.int64), minlength=len(numbers))
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(numbers), dtype="<u4")
    rank[order] = np.arange(len(numbers), dtype="<u4")
    words = list(numbers)
    return [words[i] for i in order.tolist()], [rank[c] for c in coded]


def _deal(words: list[str], buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, packed words, packed gaps between their numbers) of a block."""
    raw = [w.encode() for w in words]
    at = np.fromiter((zlib.crc32(w) % buckets for w in raw), np.int64, len(raw))
    order = np.argsort(at, kind="stable")
    cuts = np.flatnonzero(np.diff(at[order], prepend=-1))
    for part in np.split(order, cuts)[1:]:
        mine = [raw[i] for i in part.tolist()]
        lengths = np.array([len(w) for w in mine])
        yield int(at[part[0]]), _pack(_planes(lengths), b"".join(mine)), _pack(_planes(np.diff(part, prepend=0)))


def _blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str]]]:
    first, block, chars = 0, [], 0
    for i, value in enumerate(column):
        text = value.as_py() or ""
        if block and chars + len(text) > limit:
            yield first, block
            first, block, chars = i, [], 0
        block.append(text)
        chars += len(text)
    if block:
        yield first, block


def _index(df: DataFrame, text: str, keep: Sequence[str], pattern: str, buckets: int, block_chars: int) -> DataFrame:
    """Rows of texts (bucket -1: kept columns and numbers) and of words (bucket, packed words and gaps), by block."""
    fields = [df.schema[c] for c in keep]
    names = ["block", "bucket", "packed", "gaps", *[f"kept_{i}" for i in range(len(keep))]]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(pattern)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, texts in _blocks(batch.column(len(keep)), block_chars):
                words, coded = index_words(texts, split)
                kept = [c.slice(first, len(texts)) for c in batch.columns[: len(keep)]]
                n = len(texts)
                packed = [_pack(_planes(c)) for c in coded]
                own = [pa.array([block] * n, pa.int64()), pa.array([-1] * n, pa.int32()), pa.array(packed, pa.binary()), pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays([*own, *kept], names=names)
                dealt = list(_deal(words, buckets))
                n = len(dealt)
                own = [
                    pa.array([block] * n, pa.int64()),
                    pa.array([d[0] for d in dealt], pa.int32()),
                    pa.array([d[1] for d in dealt], pa.binary()),
                    pa.array([d[2] for d in dealt], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([*own, *[pa.nulls(n, c.type) for c in kept]], names=names)
                block += 1

    kept = "".join(f", kept_{i} {f.dataType.simpleString()}" for i, f in enumerate(fields))
    given = df.select(*[df[c].alias(f"kept_{i}") for i, c in enumerate(keep)], df[text].alias("_text"))
    return given.mapInArrow(rows, f"block long, bucket int, packed binary, gaps binary{kept}")


def _only_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pc.greater_equal(batch.column(1), 0)).select([0, 1, 2])


def _encode_words(path: str, pattern: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, pattern).encode_ordinary
        known: dict[bytes, bytes] = {}  # of the words of this partition's buckets
        for batch in batches:
            out = []
            for value in batch.column(2):
                lengths, joined = _unpack(value.as_buffer().to_pybytes(), 2)
                ends = np.cumsum(_from_planes(lengths).astype(np.int64)).tolist()
                ids, start = [], 0
                for end in ends:
                    word = joined[start:end]
                    start = end
                    found = known.get(word)
                    if found is None:
                        found = known[word] = np.array(encode(word.decode()), dtype="<u4").tobytes()
                    ids.append(found)
                counts = np.array([len(i) // 4 for i in ids])
                out.append(_pack(_planes(counts), _planes(np.frombuffer(b"".join(ids), "<u4"))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.binary())], names=["block", "bucket", "ids"])

    return rows


def _reassemble(keep: int):
    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        found = dict(zip(right["bucket"].to_pylist(), right["ids"].to_pylist(), strict=True))
        is_text = pc.less(left["bucket"], 0)
        numbers, counts, flat = [], [], []
        words = left.filter(pc.invert(is_text))
        for bucket, gaps in zip(words["bucket"].to_pylist(), words["gaps"].to_pylist(), strict=True):
            n, ids = _unpack(found[bucket], 2)
            numbers.append(np.cumsum(_from_planes(_unpack(gaps, 1)[0]).astype(np.int64)))
            counts.append(_from_planes(n).astype(np.int64))
            flat.append(_from_planes(ids))
        empty = np.zeros(0, np.int64)
        number, count, ids = (np.concatenate([*x, empty]).astype(np.int64) for x in (numbers, counts, flat))
        ids = ids.astype("<u4")
        start, size = np.empty(len(number), np.int64), np.empty(len(number), np.int64)
        start[number], size[number] = np.cumsum(count) - count, count
        texts = left.filter(is_text)
        out = []
        for packed in texts["packed"]:
            at = _from_planes(_unpack(packed.as_buffer().to_pybytes(), 1)[0])
            n = size[at]
            total = np.cumsum(n)
            where = np.repeat(start[at] - total + n, n) + np.arange(total[-1] if len(total) else 0)
            out.append(ids[where].tobytes())
        kept = [texts[f"kept_{i}"] for i in range(keep)]
        return pa.table([*kept, pa.array(out, pa.binary())], names=[*[f"kept_{i}" for i in range(keep)], "ids"])

    return block


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",), block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The ``keep`` columns and ``ids`` of every whole text; one row for each row of ``df``.

    A null text counts as empty and has no ids. Strings that look like special tokens are ordinary
    text. A ``keep`` column named ``ids`` is left out; repeated rows each get theirs.
    """
    keep = [c for c in keep if c.lower() != "ids"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # read twice below; both reads share one shuffle
    by_block = _index(df, text, keep, pattern, 4 * parts, block_chars).repartition(parts, "block")
    words = by_block.mapInArrow(_only_words, "block long, bucket int, packed binary")
    ids = words.repartition(parts, "bucket").mapInArrow(_encode_words(path, pattern), "block long, bucket int, ids binary")
    kept = "".join(f"kept_{i} {df.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    joined = by_block.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_reassemble(len(keep)), kept + "ids binary")
    return joined.select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)], "ids")


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ids stand for; null ids give null, an unknown id is an error.

    A column that is named as the new one is replaced.
    """
    df = without(df, [decoded], [ids])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(_decoder(path, df.columns.index(ids), [*df.columns, decoded]), f"{schema}, `{decoded}` binary")


def _decoder(path: str, at: int, names: list[str]):
    """Joins the ids in column ``at`` with the token-byte table."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _token_bytes(path).__getitem__
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(first, ROWS_AT_ONCE)
                out = [
                    None if v.as_buffer() is None else b"".join(map(token, np.frombuffer(v.as_buffer(), "<u4").tolist()))
                    for v in batch.column(at)
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=names)

    return rows


def _digests(path: str):
    """doc_id, n_tokens and digests of ids and of the decoded bytes, of rows of doc_id and ids."""
    decoded = _decoder(path, 1, ["doc_id", "ids", "decoded"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = {i: str(i).encode() for i in _token_bytes(path)}.__getitem__
        for batch in decoded(batches):
            n, said, raw = [], [], []
            for ids, back in zip(batch.column(1), batch.column(2), strict=True):
                found = np.frombuffer(ids.as_buffer(), "<u4").tolist()
                n.append(len(found))
                said.append(hashlib.sha256(b" ".join(map(spelled, found))).hexdigest())
                raw.append(hashlib.sha256(back.as_buffer()).hexdigest())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(said, pa.string()), pa.array(raw, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows


@query("op1_byte_bpe")
def op1(spark, sf_dir):
    """All documents encoded and decoded again; decoding and digests share a worker."""
    path = default_path()
    encoded = encode(table(spark, sf_dir, "documents"), path, default_pattern())
    return encoded.mapInArrow(_digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
