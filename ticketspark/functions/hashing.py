"""Reproducible pseudo-random values.

They depend on keys and a seed alone, so a lost task that runs again picks the same rows, and any
SQL engine with md5 can recompute them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 52
_PRIME = 2147483647


def key_hash(*keys: Column, seed: int = 42) -> Column:
    """52 uniform bits from the text of the keys."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def hash_bucket(h: Column, bits: int = 12) -> Column:
    """Leading bits of a hash: 2**bits equal ranges, in the order of the hash."""
    return F.shiftright(h, HASH_BITS - bits)


def mix(slot: Column, replicate: Column, seed: int = 42) -> Column:
    """Pseudo-random long below 2**31-1 from two non-negative integers; integer arithmetic only."""
    a = F.pmod(slot.cast("long"), F.lit(_PRIME))
    b = F.pmod(replicate.cast("long"), F.lit(_PRIME))
    x = F.pmod(a * 48271 + b * 69621 + seed * 16807 + 12345, F.lit(_PRIME))
    x = F.pmod(x * x + b, F.lit(_PRIME))
    x = F.pmod(x * 40692 + a, F.lit(_PRIME))
    return F.pmod(x * x + a, F.lit(_PRIME))
