"""Choosing the decision threshold of a scored table."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import bisect_right
from ledgerlens.operators.evaluation import _with_ratios
from ledgerlens.sources import local_table

# 0.01, 0.02, .. 0.99
DEFAULT_THRESHOLDS = tuple(i / 100.0 for i in range(1, 100))


def threshold_sweep(
    df: DataFrame,
    score: str = "p1",
    label: str = "label",
    thresholds: Sequence[float] = DEFAULT_THRESHOLDS,
) -> DataFrame:
    """Confusion counts and metrics of `score >= t` for every threshold t.

    Each row is counted once, under the number of thresholds it reaches; the
    counts per threshold are running sums over those groups. One pass and one
    partial aggregate of at most len(thresholds) + 1 groups, whatever the size
    of the table.
    """
    cuts = sorted(float(t) for t in thresholds)
    groups = df.groupBy(bisect_right(score, cuts).alias("reached")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    grid = local_table(
        df.sparkSession,
        [("reached", pa.int32()), ("threshold", pa.float64())],
        enumerate([None, *cuts]),
    )
    # At most len(thresholds) + 1 rows reach these windows.
    above = Window.orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.orderBy(F.asc("reached")).rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        grid.join(groups, "reached", "left")
        .select(
            "threshold",
            F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("tp"),
            F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("fp"),
            F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("fn"),
            F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("tn"),
        )
        .filter(F.col("threshold").isNotNull())
    )
    return _with_ratios(counts)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """One row: the threshold of highest F1, the lowest on a tie; (0.5, 0.0) if no F1 is positive."""
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("t")))
    top = sweep.filter(F.col("f1") > 0).agg(best.alias("best"))
    return top.select(
        F.coalesce(-F.col("best.t"), F.lit(0.5)).alias("threshold"),
        F.coalesce(F.col("best.f1"), F.lit(0.0)).alias("f1"),
    )
