"""License scans: template markup compiled into token automata, run over the words of a text.

A template is licence wording with two kinds of markup:

* ``<<beginOptional>> ... <<endOptional>>``: wording that may be left out (may be nested);
* ``<<var;1;4>>``: a replaceable region of 1 to 4 words, whatever they are.

Everything else is mandatory and must stand word for word, in order, with nothing between. Case,
punctuation and white space do not matter, since texts and templates are compared by words: maximal
runs of digits, letters a-z (A-Z is lowered) and characters beyond ASCII.

An automaton starts only where the template's rarest mandatory word stands at a distance that fits,
so a text without that word costs one search in its bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .registry import query, table

_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_MARKUP = re.compile(r"<<(.*?)>>", re.DOTALL)


def normalised(text: bytes) -> bytes:
    """UTF-8 text with A-Z lowered and every byte outside words made a space."""
    return text.translate(_TABLE)


@dataclass(frozen=True)
class Automaton:
    """A token automaton: ``steps[state]`` lists (word or None for any word, next state)."""

    label: str
    steps: tuple[tuple[tuple[bytes | None, int], ...], ...]
    final: frozenset[int]
    start: frozenset[int]
    anchor: bytes
    offsets: frozenset[int]

    def match(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted run of words that starts at ``at``, or -1."""
        states, end = self.start, at if self.start & self.final else -1
        for i in range(at, len(words)):
            word = words[i]
            states = frozenset(n for s in states for w, n in self.steps[s] if w is None or w == word)
            if not states:
                break
            if states & self.final:
                end = i + 1
        return end

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(start, end) of accepted runs, every start that accepts, in order."""
        starts = {i - o for i, w in enumerate(words) if w == self.anchor for o in self.offsets if i >= o}
        for at in sorted(starts):
            if (end := self.match(words, at)) >= 0:
                yield at, end


def compile_template(label: str, template: str) -> Automaton:
    """Automaton of a template; ``ValueError`` for markup that does not close or without mandatory words."""
    edges: list[list[tuple[bytes | None, int]]] = [[]]
    skips: list[list[int]] = [[]]
    mandatory: list[tuple[bytes, frozenset[int]]] = []
    # how many words may stand before this place, from the start of the template
    before = {0: frozenset([0])}
    here, open_at = 0, []

    def add(word: bytes | None) -> None:
        nonlocal here
        edges.append([])
        skips.append([])
        edges[here].append((word, len(edges) - 1))
        before[len(edges) - 1] = frozenset(n + 1 for n in before[here])
        here = len(edges) - 1

    def skip(state: int) -> None:
        skips[state].append(here)
        before[here] = before[here] | before[state]

    pieces = _MARKUP.split(template)
    for k, piece in enumerate(pieces):
        if k % 2 == 0:
            for word in normalised(piece.encode()).split():
                if not open_at:
                    mandatory.append((word, before[here]))
                add(word)
        elif piece == "beginOptional":
            open_at.append(here)
        elif piece == "endOptional" and open_at:
            skip(open_at.pop())
        elif m := re.fullmatch(r"var;(\d+);(\d+)", piece):
            least, most = int(m[1]), int(m[2])
            passed = []
            for i in range(most):
                if i >= least:
                    passed.append(here)
                add(None)
            for state in passed:
                skip(state)
        else:
            raise ValueError(f"markup <<{piece}>> in template {label}")
    if open_at or not mandatory:
        raise ValueError(f"template {label} has an open region or no mandatory word")

    def reach(state: int) -> frozenset[int]:
        found, todo = {state}, [state]
        while todo:
            for n in skips[todo.pop()]:
                if n not in found:
                    found.add(n)
                    todo.append(n)
        return frozenset(found)

    closed = [reach(s) for s in range(len(edges))]
    steps = tuple(tuple((w, n) for w, t in edge for n in closed[t]) for edge in edges)
    anchor, offsets = max(mandatory, key=lambda x: (len(x[0]), x[0]))
    return Automaton(label, steps, frozenset([here]), closed[0], anchor, offsets)


def find_phrase(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Starts of the places where the phrase's words stand consecutively, overlapping ones included."""
    n, first = len(phrase), phrase[0]
    return [i for i, w in enumerate(words) if w == first and words[i : i + n] == phrase]


# fixed values: the given phrases and their labels
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}

# fixed values: notices that name a licence
NOTICES = [
    ("mit", "<<beginOptional>>is <<endOptional>>released under the <<beginOptional>>terms of the <<endOptional>>MIT License"),
    ("mit", "<<beginOptional>>is <<endOptional>>licensed under the <<beginOptional>>terms of the <<endOptional>>MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2<<beginOptional>>.0<<endOptional>>"),
    ("cc-by-nc", "licensed under <<beginOptional>>a <<endOptional>>CC BY-NC<<beginOptional>> <<var;1;2>><<endOptional>>"),
    (
        "gpl",
        "<<beginOptional>>This work is <<endOptional>>licensed under the <<beginOptional>>terms of the <<endOptional>>GNU General Public "
        "License<<beginOptional>>, version <<var;1;2>><<endOptional>>",
    ),
    ("proprietary", "<<beginOptional>>Copyright <<var;1;6>> <<endOptional>>All rights reserved"),
]

# fixed values: licence texts, whole, from the grant to the end of the disclaimer
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "<<beginOptional>>(subject to the limitations in the disclaimer below) <<endOptional>>provided that the following "
    "conditions are met: <<beginOptional>>1. <<endOptional>>Redistributions of source code must retain the above copyright notice, this "
    "list of conditions and the following disclaimer. <<beginOptional>>2. <<endOptional>>Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. "
)
_BSD_ENDORSEMENT = (
    "<<beginOptional>>3. <<endOptional>>Neither the name of <<var;1;12>> nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    "This software is provided by <<var;1;12>> as is and any express or implied warranties, including, but not limited to, the implied "
    "warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall <<var;1;12>> be liable for any "
    "direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of "
    "substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of "
    "liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use "
    "of this software, even if advised of the possibility of such damage."
)
TEXTS = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the <<var;1;2>>), to deal in the <<var;1;2>> without restriction, including without limitation the rights "
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the <<var;1;2>>, and to permit persons to "
        "whom the <<var;1;2>> is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
        "notice <<beginOptional>>(including the next paragraph) <<endOptional>>shall be included in all copies or substantial portions of "
        "the <<var;1;2>>. The <<var;1;2>> is provided as is, without warranty of any kind, express or implied, including but not limited "
        "to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall <<var;1;12>> be "
        "liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or "
        "in connection with the <<var;1;2>> or the use or other dealings in the <<var;1;2>>.",
    ),
    ("bsd-2", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("bsd-3", _BSD_CONDITIONS + _BSD_ENDORSEMENT + _BSD_DISCLAIMER),
    (
        "isc",
        "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. The software is "
        "provided as is and <<var;1;12>> disclaims all warranties with regard to this software including all implied warranties of "
        "merchantability and fitness. In no event shall <<var;1;12>> be liable for any special, direct, indirect, or consequential damages "
        "or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other "
        "tortious action, arising out of or in connection with the use or performance of this software.",
    ),
    (
        "apache-2-header",
        "Licensed under the Apache License, Version 2.0 (the <<var;1;2>>); you may not use this <<var;1;3>> except in compliance with the "
        "<<var;1;2>>. You may obtain a copy of the <<var;1;2>> at <<var;1;1>>://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the <<var;1;2>> is distributed on an as is basis, without "
        "warranties or conditions of any kind, either express or implied. See the <<var;1;2>> for the specific language governing "
        "permissions and limitations under the <<var;1;2>>.",
    ),
]
TEMPLATES = [*NOTICES, *TEXTS]


@dataclass(frozen=True)
class Scanner:
    phrases: Mapping[str, list[bytes]]
    automata: tuple[Automaton, ...]

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int]]]:
        """Number of words, (start, label) of base phrases, (label, start, end) of accepted templates."""
        clean = normalised(text)
        words = clean.split()
        base, accepted = [], []
        for label, phrase in self.phrases.items():
            # the longest word decides quickly that a text lacks the phrase
            if max(phrase, key=len) in clean:
                base += [(i, label) for i in find_phrase(words, phrase)]
        for a in self.automata:
            if a.anchor in clean:
                accepted += [(a.label, i, j) for i, j in a.find(words)]
        return len(words), sorted(base), accepted


def make_scanner(phrases: Mapping[str, str] = PHRASES, templates=tuple(TEMPLATES)) -> Scanner:
    split = {label: normalised(p.encode()).split() for label, p in phrases.items()}
    if not all(split.values()):
        raise ValueError("a phrase without words")
    return Scanner(split, tuple(compile_template(label, t) for label, t in templates))


_FIELDS = [
    ("n_words", pa.int64()),
    ("n_base", pa.int64()),
    ("first_word", pa.int64()),
    ("last_word", pa.int64()),
    ("base_labels", pa.string()),
    ("labels", pa.string()),
    ("score", pa.float64()),
    ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
]
_DDL = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, start: long, end: long>>"
)


def scan_licenses(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), scanner: Scanner | None = None) -> DataFrame:
    """The ``keep`` columns of ``df`` with what was found in each whole text; one row for each row.

    ``spans`` are the word ranges that templates accept. ``score`` is 1 if a template accepts, 0.5 if
    only base phrases stand there, else 0. A null or empty text has no words and no labels. Work goes
    row by row where the rows lie; nothing is shuffled. ``keep`` columns named as an added one are left
    out.
    """
    scanner = scanner or make_scanner()
    keep = tuple(c for c in keep if c.lower() not in {n for n, _ in _FIELDS})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(len(keep)):
                raw = value.as_buffer()
                n, base, accepted = scanner.scan(raw.to_pybytes() if raw is not None else b"")
                named = {label for _, label in base}
                every = named | {label for label, _, _ in accepted}
                out.append(
                    {
                        "n_words": n,
                        "n_base": len(base),
                        "first_word": base[0][0] if base else None,
                        "last_word": base[-1][0] if base else None,
                        "base_labels": ",".join(sorted(named)),
                        "labels": ",".join(sorted(every)),
                        "score": 1.0 if accepted else 0.5 if base else 0.0,
                        "spans": [{"label": label, "start": i, "end": j} for label, i, j in accepted],
                    }
                )
            added = [pa.array([r[name] for r in out], kind) for name, kind in _FIELDS]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *added], names=[*keep, *[n for n, _ in _FIELDS]])

    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    # the text goes to the tasks as its bytes
    given = df.select(*[df[c] for c in keep], df[text].cast("binary").alias("_text_bytes"))
    return given.mapInArrow(rows, f"{kept}, {_DDL}" if kept else _DDL)


def as_regex(template: str) -> str:
    """A regular expression for a template, over words that each end in a space; only for checks in SQL."""
    out = ""
    for k, piece in enumerate(_MARKUP.split(template)):
        if k % 2 == 0:
            out += "".join(w.decode() + " " for w in normalised(piece.encode()).split())
        elif piece == "beginOptional":
            out += "(?:"
        elif piece == "endOptional":
            out += ")?"
        else:
            _, least, most = piece.split(";")
            out += f"(?:[^ ]+ ){{{least},{most}}}"
    return out


def _sql() -> str:
    """The scan in SQL: phrases by list slices, templates by regular expressions over the joined words."""
    names = sorted(PHRASES)
    starts, named = [], []
    for i, label in enumerate(names):
        words = PHRASES[label].split()
        listed = ", ".join(f"'{w}'" for w in words)
        starts.append(f"list_filter(range(1, len(ws) + 1), lambda i: ws[i:i + {len(words) - 1}] = [{listed}]) AS p{i}")
        named.append(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END")
    accepted = [f"CASE WHEN regexp_matches(t, ' {as_regex(template)}') THEN '{label}' END" for label, template in TEMPLATES]
    joined = lambda c: f"array_to_string(list_sort(list_distinct(list_filter({c}, lambda x: x IS NOT NULL))), ',')"
    every = " || ".join(f"p{i}" for i in range(len(names)))
    upper = "".join(chr(c) for c in range(65, 91))
    return rf"""
    WITH d AS (
        SELECT doc_id, regexp_replace(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g') AS t
        FROM documents
    ),
    w AS (SELECT doc_id, list_filter(string_split(t, ' '), lambda x: x <> '') AS ws FROM d),
    p AS (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS t, {", ".join(starts)} FROM w),
    m AS (SELECT doc_id, ws, {every} AS places, [{", ".join(named)}] AS base, [{", ".join(accepted)}] AS own FROM p)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
        CAST(list_min(places) - 1 AS BIGINT) AS first_word, CAST(list_max(places) - 1 AS BIGINT) AS last_word,
        {joined("base")} AS base_labels, {joined("base || own")} AS labels,
        CAST(CASE WHEN len(list_filter(own, lambda x: x IS NOT NULL)) > 0 THEN 1 WHEN len(places) > 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS score
    FROM m
    """


@query("op2_license_scans", _sql())
def op2(spark, sf_dir):
    """All documents scanned."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
