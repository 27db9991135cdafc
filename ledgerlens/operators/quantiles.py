"""Exact quantiles of many columns by narrowing brackets.

A global `percentile` keeps every distinct value of a column in one buffer.
Here each pass counts values in sub-ranges of a bracket known to hold the
wanted rank, and the bracket shrinks to the sub-range that holds it. A pass is
a scan with a partial aggregate of a few hundred groups per rank; a handful of
passes leave one value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.sources import local_table

_SLICES = 512


def exact_quantiles(
    df: DataFrame, features: Sequence[str], marks: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each feature, missing values left out."""
    features, spark = list(features), df.sparkSession
    # NaN counts as missing; infinities are values at the ends.
    values = df.selectExpr(*[f"nanvl(cast(`{c}` as double), null) as `{c}`" for c in features])
    stats = values.selectExpr(
        *[f"{fn}(`{c}`) as `{name}_{c}`" for c in features for name, fn in (("n", "count"), ("lo", "min"), ("hi", "max"))]
    ).first()

    # Rank of the lower neighbour of each quantile, and of the upper one.
    wanted = {
        c: [(m * (stats[f"n_{c}"] - 1)) for m in marks] for c in features if stats[f"n_{c}"] > 0
    }
    ranks = {(c, k) for c, ps in wanted.items() for p in ps for k in (math.floor(p), math.ceil(p))}
    # (feature, rank) -> lowest value, highest value, rank within the bracket
    open_, found = {}, {}
    ends = _infinite(values, features)
    for c, k in ranks:
        lo, hi, (below, above) = stats[f"lo_{c}"], stats[f"hi_{c}"], ends[c][:2]
        if k < below or k >= stats[f"n_{c}"] - above:
            found[c, k] = -math.inf if k < below else math.inf
            continue
        lo, hi, k_in = ends[c][2], ends[c][3], k - below
        if lo == hi:
            found[c, k] = lo
        else:
            open_[c, k] = (lo, hi, k_in)

    while open_:
        # Ranks that still share a bracket are counted together.
        brackets = sorted({(c, lo, hi) for (c, _), (lo, hi, _) in open_.items()})
        bracket = [("feature", pa.string()), ("lo", pa.float64()), ("hi", pa.float64())]
        targets = local_table(
            spark,
            [*bracket, ("k", pa.int64()), ("within", pa.int64())],
            [(c, lo, hi, k, within) for (c, k), (lo, hi, within) in sorted(open_.items())],
        )
        grid = local_table(spark, bracket, brackets)
        names = sorted({c for c, _, _ in brackets})
        long = values.unpivot([], names, "feature", "v")
        slice_ = _slice()
        counted = (
            # The brackets are two per quantile and feature at most.
            long.join(F.broadcast(grid), "feature")
            .filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
            .groupBy("feature", "lo", "hi", slice_.alias("slice"))
            .agg(F.count("*").alias("n"), F.min("v").alias("vmin"), F.max("v").alias("vmax"))
        )
        upto = Window.partitionBy("feature", "lo", "hi").orderBy("slice")
        placed = counted.withColumn("end", F.sum("n").over(upto)).withColumn("start", F.col("end") - F.col("n"))
        hits = (
            placed.join(F.broadcast(targets), ["feature", "lo", "hi"])
            .filter((F.col("within") >= F.col("start")) & (F.col("within") < F.col("end")))
            .select("feature", "k", "vmin", "vmax", (F.col("within") - F.col("start")).alias("within"))
            .collect()
        )
        open_ = {}
        for hit in hits:
            if hit.vmin == hit.vmax:
                found[hit.feature, hit.k] = hit.vmin
            else:
                open_[hit.feature, hit.k] = (hit.vmin, hit.vmax, hit.within)

    def interpolate(c: str, position: float) -> float:
        low, high = found[c, math.floor(position)], found[c, math.ceil(position)]
        if low == high or position == math.floor(position):
            return low
        return low + (high - low) * (position - math.floor(position))

    return {c: [interpolate(c, p) for p in wanted[c]] if c in wanted else [None] * len(marks) for c in features}


def _infinite(values: DataFrame, features: list[str]) -> dict[str, tuple]:
    """For each feature: how many values are infinite at either end, the least and the greatest finite value."""
    inf = F.lit(math.inf)
    columns = []
    for i, c in enumerate(features):
        v = F.col(f"`{c}`")
        finite = F.when(F.abs(v) < inf, v)
        columns += [F.count_if(v == -inf).alias(f"b{i}"), F.count_if(v == inf).alias(f"a{i}")]
        columns += [F.min(finite).alias(f"l{i}"), F.max(finite).alias(f"h{i}")]
    row = values.agg(*columns).first()
    return {c: tuple(row[f"{x}{i}"] for x in "balh") for i, c in enumerate(features)}


def _slice() -> Column:
    """The slice of a bracket that a value falls in, 0 for the least and the last for the greatest.

    Brackets that span magnitudes are cut by the logarithm, others evenly, so a
    pass always shrinks its bracket, and few passes do for values of any size.
    """
    v, lo, hi = (_magnitude(F.col(x)) for x in ("v", "lo", "hi"))
    wide = (v - lo) / (hi - lo)
    even = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    part = F.when(hi - lo >= 3, wide).otherwise(even)
    return F.least(F.floor(part * _SLICES), F.lit(_SLICES - 1))


def _magnitude(v: Column) -> Column:
    """The signed logarithm, shifted so that it grows with the value over all doubles."""
    return F.signum(v) * F.coalesce(F.ln(F.abs(v)) + 750, F.lit(0.0))
