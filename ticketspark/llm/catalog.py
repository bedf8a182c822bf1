"""The registered queries of this subpackage."""

from . import bpe, chat, divergence, hamming, licenses, neardup, packing, quality, resampling, sharding, tokengroups, toxicity, urls  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
