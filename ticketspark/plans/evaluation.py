"""Prediction table to the report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluate
from ..session import materialize


def report(
    preds: DataFrame, baselines: Sequence[str] = evaluate.BASELINES, banded: str | None = None, replicates: int = 1000,
    key: Sequence[str] = ("date",),
) -> dict[str, DataFrame]:
    """All report tables. The predictions are written once and every table reads that copy."""
    preds = materialize(preds, "predictions")
    test = preds.where("split = 'test'")
    board = evaluate.summarize(test, ["horizon", "model"])
    best = evaluate.winners(board)
    out = {
        "leaderboards": evaluate.leaderboards(preds),
        "matrix": evaluate.leaderboard_matrix(board, [1, 3, 7]),
        "winners": best,
        "improvement": evaluate.improvement(board, baselines),
        "worst_days": evaluate.worst_days(evaluate.calibration_pairs(test, board), ties=key),
        "by_weekday": evaluate.segment_error(test, "weekday"),
        "by_month": evaluate.segment_error(test, "month"),
        "totals": evaluate.totals(test, ["horizon", "model"]),
        "intervals": evaluate.bootstrap_ci(preds, key=key, replicates=replicates),
    }
    if banded:
        one = preds.where(F.col("model") == banded)
        bands = evaluate.conformal(one.where("split = 'val'"), one.where("split = 'test'"))
        out["coverage"] = evaluate.coverage(bands)
    return out
