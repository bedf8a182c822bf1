"""URL verdicts by Bloom filter cascades: exact membership of rule keys without a join.

A rule is a host and a path prefix, written together (``example.org/es/``), and fits the host, all
its subdomains, and paths that start with the prefix. Everything a rule list could hold about a URL
is therefore a *candidate key*: a suffix of the host, at a dot, and a prefix of the path as long as
some rule's. The candidate keys of all URLs are the key universe.

A cascade answers membership for that universe. Level 1 is a Bloom filter of the listed keys; level 2
holds the keys of the universe that pass level 1 without being listed; level 3 the listed keys that
pass level 2; and so on until no key is answered wrongly. A key is listed exactly when the first
level that does not hold it has an even number (or, if all hold it, when their number is odd).

Only the distinct false positives of a level are gathered, and level 1 is sized by the ratio of
universe to list so that they are fewer than the listed keys; each later level halves them. The
filters' size therefore follows the list, not the corpus; ``MAX_BITS`` bounds what is sent to tasks.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .registry import query, table, without

MAX_BITS = 1 << 22
MAX_LEVELS = 64


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, prefix_lengths: Sequence[int]) -> Column:
    """Every host suffix joined with every path prefix of the given lengths that the path has.

    A host has few labels, so the array is short; an empty host has no keys.
    """
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = [F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(prefix_lengths))]
    heads = F.array_compact(F.array(*prefixes)) if prefixes else F.array().cast("array<string>")
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda p: F.concat(s, p))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    hashes: int
    words: np.ndarray

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.number), F.lit(i), key), F.lit(self.bits)) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words = F.lit(self.words)
        tests = []
        for p in self.positions(key):
            word = F.element_at(words, (F.shiftright(p, 6) + 1).cast("int"))
            tests.append(F.getbit(word, p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


def _fill(keys: DataFrame, n: int, number: int, rate: float) -> Level:
    """A Bloom filter of ``n`` distinct keys; the bits are set by tasks and only its words are gathered."""
    hashes = max(1, math.ceil(-math.log2(rate)))
    bits = max(64, 64 * math.ceil(n * hashes / math.log(2) / 64))
    if bits > MAX_BITS:
        raise ValueError(f"level {number} needs {bits} bits; at most {MAX_BITS} are sent to tasks")
    level = Level(number, bits, hashes, np.zeros(bits // 64, dtype=np.int64))
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("p"))
    # shiftleft of a long by 63 gives the sign bit, so all 64 bits of a word are used
    word = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("b")
    )
    for row in word.collect():  # at most bits / 64 rows
        level.words[row["w"]] = row["b"]
    return level


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def member(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(~level.holds(key), F.lit(level.number % 2 == 0)).otherwise(answer)
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, universe_size: int) -> Cascade:
    """Cascade of the distinct non-null ``key`` values of ``listed`` over those of ``universe``.

    ``universe`` may repeat keys; it is read once. ``universe_size`` is an estimate of its distinct
    keys and only sizes level 1. An empty list gives a cascade without levels, which holds nothing.
    """
    inside = materialize(listed.select("key").where(F.col("key").isNotNull()).distinct(), "listed-keys")
    levels: list[Level] = []
    outside = None
    while len(levels) < MAX_LEVELS:
        number = len(levels) + 1
        side = inside if number % 2 else outside
        n = side.count()
        if n == 0:
            return Cascade(tuple(levels))
        rate = min(0.5, math.sqrt(0.5) * n / max(universe_size, 1)) if number == 1 else 0.5
        level = _fill(side, n, number, max(rate, 2.0**-30))
        levels.append(level)
        if number == 1:
            passed = universe.select("key").where(F.col("key").isNotNull() & level.holds(F.col("key"))).distinct()
            outside = materialize(passed.join(inside, "key", "left_anti"), "false-positives")
        elif number % 2:
            outside = materialize(outside.where(level.holds(F.col("key"))), "false-positives")
        else:
            inside = materialize(inside.where(level.holds(F.col("key"))), "false-negatives")
    raise ValueError(f"the cascade has wrong answers after {MAX_LEVELS} levels")


def longest(keys: Column) -> Column:
    """The longest of an array of keys, null if there is none."""
    return F.array_max(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))))["key"]


def judge_urls(
    urls: DataFrame, rules: DataFrame, blocked_hosts: DataFrame, prefix_lengths: Sequence[int], url: str = "url"
) -> DataFrame:
    """``urls`` with host, path, rule and verdict.

    ``rules`` has key and verdict (allow or block), ``blocked_hosts`` has key (a host; its subdomains
    count too). ``prefix_lengths`` are the lengths of the rules' paths. The longest rule that fits
    gives the verdict; without one, a blocked host blocks and everything else is allowed. A null URL
    has empty host and path and is allowed. Repeated URLs each get their row. Other columns of ``urls``
    named as the added ones, or ``_keys``, ``_hosts``, ``_allow``, ``_block``, ``_host``, are left out.
    """
    urls = without(urls, ["host", "path", "rule", "verdict", "_keys", "_hosts", "_allow", "_block", "_host"], [url])
    host, path = url_parts(F.col(url))
    parts = urls.withColumns({"host": host, "path": path})
    keyed = parts.withColumns(
        {"_keys": candidate_keys(F.col("host"), F.col("path"), prefix_lengths), "_hosts": candidate_keys(F.col("host"), F.lit(""), [0])}
    )
    of_rules = keyed.select(F.explode("_keys").alias("key"))
    of_hosts = keyed.select(F.explode("_hosts").alias("key"))
    n = of_rules.agg(F.approx_count_distinct("key")).first()[0]
    m = of_hosts.agg(F.approx_count_distinct("key")).first()[0]
    allow = build_cascade(rules.where(F.col("verdict") == "allow"), of_rules, n)
    block = build_cascade(rules.where(F.col("verdict") == "block"), of_rules, n)
    hosts = build_cascade(blocked_hosts, of_hosts, m)
    fits_allow = longest(F.filter("_keys", allow.member))
    fits_block = longest(F.filter("_keys", block.member))
    judged = keyed.withColumns({"_allow": fits_allow, "_block": fits_block, "_host": F.exists("_hosts", hosts.member)})
    blocks = F.coalesce(F.length("_block"), F.lit(-1)) > F.coalesce(F.length("_allow"), F.lit(-1))
    rule = F.when(blocks, F.col("_block")).otherwise(F.col("_allow"))
    verdict = F.when(blocks, F.lit("block")).when(F.col("_allow").isNull() & F.col("_host"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumns({"rule": rule, "verdict": verdict}).drop("_keys", "_hosts", "_allow", "_block", "_host")


# fixed values: the given rules, and hosts of spam, gambling, adult and advertising pages
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
BLOCKED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
BLOCKED_HOSTS = [f"{name}.example.{top}" for name in BLOCKED_NAMES for top in ("com", "net", "org")]


def rule_frame(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "key string, verdict string")


def path_lengths(rules: Sequence[tuple[str, str]]) -> list[int]:
    return sorted({len(key) - key.index("/") for key, _ in rules})


_RULE_VALUES = ", ".join(f"('{k}', '{k[: k.index('/')]}', '{k[k.index('/') :]}', '{v}')" for k, v in RULES)
_HOST_TESTS = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in BLOCKED_HOSTS)


@query(
    "op8_url_filters",
    rf"""
    WITH rules(key, rule_host, rule_path, verdict) AS (VALUES {_RULE_VALUES}),
    rest AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
    ),
    parts AS (
        SELECT page_id,
            translate(regexp_extract(r, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
            regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
        FROM rest
    ),
    fits AS (
        SELECT page_id, max_by(key, length(key)) AS rule, max_by(verdict, length(key)) AS verdict
        FROM (SELECT DISTINCT page_id, host, path FROM parts) JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY page_id
    )
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN {_HOST_TESTS} THEN 'block' ELSE 'allow' END) AS verdict
    FROM parts LEFT JOIN fits USING (page_id)
    """,
)
def op8(spark, sf_dir):
    """Every page judged by the given rules, else by the list of blocked hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = spark.createDataFrame([(h,) for h in BLOCKED_HOSTS], "key string")
    judged = judge_urls(pages, rule_frame(spark, RULES), hosts, path_lengths(RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")
