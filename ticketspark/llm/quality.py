"""Quality rules as a short-circuit cascade, in Spark expressions alone.

Each rule rejects a document by an expression over its text and its words. On a sample every rule is
timed and its rejections are counted; rules then run in the order of rejections per second, in one
CASE. ``passed`` computes the words once and everything else inside the branch that needs it, so an
expensive rule is evaluated only for documents that the cheaper or sharper ones let pass. ``judge``
also returns all measures, and so has to take them of every document; there the CASE only compares.
The order changes the work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import query, table, without

#: Documents that the order of the rules is estimated on, one in ``SAMPLE_STEP`` by hash from the start
#: of the table, each judged ``SAMPLE_TIMES`` times. The verdict does not depend on them.
SAMPLE_ROWS, SAMPLE_STEP, SAMPLE_TIMES = 500, 8, 8

#: A rule: from the text and its words to true where it rejects.
Rule = Callable[[Column, Column], Column]

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"


def words(text: Column) -> Column:
    """Maximal runs of characters that are not white space, in order."""
    return F.array_remove(F.split(text, SPACE), "")


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.regexp_replace(text, SPACE, "")).cast("long")


def symbols(text: Column) -> Column:
    """Characters out of ``#*$%&|<>``."""
    return F.length(F.regexp_replace(text, NOT_SYMBOL, "")).cast("long")


def lines(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; a lambda that refers to an expression computes it for every element."""
    return F.transform(F.array(value), use)[0]


def window_hashes(given: Column) -> Column:
    """A 64-bit hash of every run of three words."""
    zero = F.lit(0).cast("long")
    hashed = F.transform(given, lambda w: F.coalesce(F.xxhash64(w), zero))
    return _let(
        hashed,
        lambda all_: F.transform(
            F.slice(all_, 1, F.greatest(F.size(all_) - 2, F.lit(0))),
            lambda h, i: F.coalesce(F.xxhash64(h, F.get(all_, i + 1), F.get(all_, i + 2)), zero),
        ),
    )


def covered_by_repeats(hashes: Column) -> Column:
    """Words that lie in a three-word window found twice or more, the first one included.

    Windows are sorted by hash, so equal ones stand side by side; the words they cover follow from
    the sorted starts, each window adding at most the three words up to the next start. A text in
    which all windows differ is done after one look for duplicates.
    """
    none = F.lit(0).cast("long")

    def starts(ordered: Column) -> Column:
        alike = lambda x, k: (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"])
        return F.sort_array(F.array_compact(F.transform(ordered, lambda x, k: F.when(alike(x, k), x["i"]))))

    def covered(found: Column) -> Column:
        reach = F.transform(found, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(found, k + 1) - s, F.lit(3))))
        return F.aggregate(reach, none, lambda a, x: a + x)

    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = _let(_let(ordered, starts), covered)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none).otherwise(repeats)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (all long).

    A null text has none of anything. Arrays stay inside their row: nothing is shuffled. Other columns
    with these names, or ``_text``, ``_words``, ``_lines``, ``_hashes``, are left out.
    """
    own = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "_text", "_words", "_lines", "_hashes"]
    given = without(docs, own, [text]).withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    split = given.withColumns({"_words": words(F.col("_text")), "_lines": lines(F.col("_text"))})
    hashed = split.withColumn("_hashes", window_hashes(F.col("_words")))
    counted = hashed.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": word_chars(F.col("_text")),
            "n_symbols": symbols(F.col("_text")),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered_by_repeats(F.col("_hashes")),
        }
    )
    return counted.drop("_text", "_words", "_lines", "_hashes")


def default_rules() -> dict[str, Column]:
    """Rejections by name, over the columns that ``measure`` adds.

    Few words; repeated wording; symbols in place of words; repeated lines; words of odd length.
    """
    n = F.col("n_words")
    return {
        "few_words": n < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * n,
        "symbols": 100 * F.col("n_symbols") > 20 * n,
        "repeated_lines": 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"),
        "short_words": F.col("word_chars") < 2 * n,
        "long_words": F.col("word_chars") > 20 * n,
    }


def lazy_rules() -> dict[str, Rule]:
    """The rules of ``default_rules`` by name, each taking its own measures of a text when it is asked."""

    def odd_length(text: Column, words: Column) -> Column:
        n = F.size(words)
        return _let(word_chars(text), lambda c: (c < 2 * n) | (c > 20 * n))

    def repeated_lines(text: Column, words: Column) -> Column:
        return _let(lines(text), lambda found: 100 * (F.size(found) - F.size(F.array_distinct(found))) > 50 * F.size(found))

    return {
        "few_words": lambda text, words: F.size(words) < 50,
        "repeated_words": lambda text, words: 100 * _let(window_hashes(words), covered_by_repeats) > 50 * F.size(words),
        "symbols": lambda text, words: 100 * symbols(text) > 20 * F.size(words),
        "repeated_lines": repeated_lines,
        "odd_length": odd_length,
    }


def order_rules(sample: DataFrame, rules: Mapping[str, Rule], text: str = "text") -> list[str]:
    """Rule names by rejections per second on ``sample``, best first; ties by name.

    One small job a rule, and one that only splits the texts, whose time is taken from the others'.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    often = sample.select(given.alias("t"), F.explode(F.sequence(F.lit(1), F.lit(SAMPLE_TIMES)))).select("t")

    def timed(rule: Rule) -> tuple[int, float]:
        start = time.perf_counter()
        n = often.agg(F.count_if(_let(words(F.col("t")), lambda w: rule(F.col("t"), w)))).first()[0]
        return n, time.perf_counter() - start

    empty = lambda t, w: F.size(w) < 0
    timed(empty)  # the first job also starts workers and compiles
    _, idle = timed(empty)
    found = []
    for name, rule in rules.items():
        n, seconds = timed(rule)
        found.append((-n / max(seconds - idle, 1e-3), name))
    return [name for _, name in sorted(found)]


def sample_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """At most ``SAMPLE_ROWS`` texts, picked by hash; reads only as many partitions as that takes.

    The rows go back as an Arrow table: a list of rows would pass through Python workers in every job over them.
    """
    picked = docs.select(F.col(text).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_STEP)) == 0)
    texts = pa.array([r["text"] for r in picked.take(SAMPLE_ROWS)], pa.string())
    return docs.sparkSession.createDataFrame(pa.table({"text": texts}), "text string")


def verdict(text: Column, rules: Mapping[str, Rule], order: list[str]) -> Column:
    """False where a rule rejects a text; the words are split once and rules behind the first that rejects do not run."""
    given = F.coalesce(text, F.lit(""))
    return _let(words(given), lambda w: cascade({name: rules[name](given, w) for name in order}, order))


def passed(docs: DataFrame, rules: Mapping[str, Rule] | None = None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, unchanged. A null text is an empty one; an empty table stays empty."""
    rules = lazy_rules() if rules is None else rules
    return docs.where(verdict(F.col(text), rules, order_rules(sample_of(docs, text), rules)))


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """False from the first rule, in the given order, that rejects; later ones are not evaluated.

    A rule that gives null does not reject.
    """
    chain = None
    for name in order:
        chain = F.when(rules[name], F.lit(False)) if chain is None else chain.when(rules[name], F.lit(False))
    return F.lit(True) if chain is None else chain.otherwise(F.lit(True))


#: The rule of ``lazy_rules`` that takes the measure of each of ``default_rules``.
_TIMED_AS = {"short_words": "odd_length", "long_words": "odd_length"}


def judge(docs: DataFrame, rules: Mapping[str, Column] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with the measured columns and ``kept``. Empty and null texts have no words and are rejected.

    ``rules`` of the caller's own run in the order given, the default ones in that of the sample. A
    column ``kept`` of the input is replaced. An empty table stays empty.
    """
    if rules is None:
        rules, place = default_rules(), {name: i for i, name in enumerate(order_rules(sample_of(docs, text), lazy_rules()))}
        order = sorted(rules, key=lambda name: place[_TIMED_AS.get(name, name)])
    else:
        order = list(rules)
    return measure(without(docs, ["kept"], [text]), text).withColumn("kept", cascade(rules, order))


@query(
    "op7_quality_rules",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    w AS (
        SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
        FROM d
    ),
    windows AS (
        SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM (SELECT doc_id, ws FROM w WHERE len(ws) >= 3)
    ),
    keyed AS (SELECT doc_id, i, [ws[i], ws[i + 1], ws[i + 2]] AS k FROM windows),
    repeated AS (SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS o) GROUP BY doc_id),
    m AS (
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
            CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
            CAST(len(ls) AS BIGINT) AS n_lines, coalesce(n, 0) AS n_repeat_words
        FROM w LEFT JOIN covered USING (doc_id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 20 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
    FROM m
    """,
)
def op7(spark, sf_dir):
    """All documents measured and judged."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.col("n_words")
    base = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept"
    )
