"""Scalar column expressions. All of them stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(key: str | Column, seed: int | str, buckets: int | None = 1000) -> Column:
    """Bucket of a key that depends on nothing but the key and the seed.

    Unlike `randomSplit` or `sample`, the result survives repartitioning,
    retries and a different reader. `buckets=None` keeps all 32 bits.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), _col(key).cast("string")))
    word = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return word if buckets is None else F.pmod(word, F.lit(buckets).cast("bigint"))


def threshold_label(score: str | Column, threshold: float | Column, inclusive: bool = True) -> Column:
    """1.0 where the score reaches (or, if not inclusive, exceeds) the threshold, else 0.0."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    hit = _col(score) >= limit if inclusive else _col(score) > limit
    return F.when(hit, 1.0).otherwise(0.0)


def guarded_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator, or 0.0 where the denominator is not positive."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def clock_hour(seconds: str | Column) -> Column:
    """Hours elapsed since the first transaction; runs on past 23."""
    return F.floor(_col(seconds) / 3600).cast("int")


def positive_probability(probability: str | Column = "probability") -> Column:
    """Probability of class 1 out of a model's probability vector."""
    return vector_to_array(_col(probability)).getItem(1)


def bisect_right(column: str, cuts: Sequence[float]) -> Column:
    """How many of the ascending cuts are <= the column, as a balanced CASE tree."""

    def node(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        cut = f"{float(cuts[mid])!r}D"
        return f"CASE WHEN `{column}` >= {cut} THEN {node(mid + 1, hi)} ELSE {node(lo, mid)} END"

    return F.expr(node(0, len(cuts)))
