"""The registered queries and the SQL each of them must agree with."""

from . import (  # noqa: F401
    q_aggregate,
    q_clean,
    q_densify,
    q_joins,
    q_metrics,
    q_models,
    q_scalar,
    q_sources,
    q_spatial,
    q_splits,
    q_windows,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
