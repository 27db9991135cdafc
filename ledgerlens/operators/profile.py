"""Describing a transaction table: counts, histogram, box plots, correlation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import pyarrow as pa
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions import clock_hour
from ledgerlens.operators.quantiles import exact_quantiles
from ledgerlens.operators.scaling import assembler
from ledgerlens.sources import local_table


def row_counts(df: DataFrame, label: str = "Class") -> DataFrame:
    """One row: all rows, and those of either class."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )


def class_distribution(df: DataFrame, label: str = "Class") -> DataFrame:
    """Rows per class, most frequent first."""
    return (
        df.groupBy(F.col(label).cast("string").alias(label))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.col(label))
    )


def hourly_class_counts(df: DataFrame, time: str = "Time", label: str = "Class") -> DataFrame:
    """Rows per elapsed hour and class; pairs that never occur are absent."""
    return df.groupBy(clock_hour(time).alias("Hour"), label).agg(F.count("*").alias("count"))


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts over equal-width bins, the last one closed on the right; empty bins count 0.

    A column of one single value gets bins of total width 1 around it.
    """
    x = F.col(column).cast("double")
    known = df.filter(x.isNotNull())
    limits = known.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = (0.0, 1.0) if limits.lo is None else (limits.lo, limits.hi)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    lo, hi = F.lit(lo), F.lit(hi)

    def edge(i):
        return lo + i * ((hi - lo) / F.lit(float(bins)))

    guess = F.least(F.floor((x - lo) * F.lit(float(bins)) / (hi - lo)), F.lit(bins - 1)).cast("int")
    # Rounding can put the guess one bin off; the edges decide.
    slot = F.col("slot")
    settled = (
        F.when((slot > 0) & (F.col("x") < edge(slot)), slot - 1)
        .when((slot < bins - 1) & (F.col("x") >= edge(slot + 1)), slot + 1)
        .otherwise(slot)
    )
    counts = (
        known.select(x.alias("x"), guess.alias("slot"))
        .groupBy((settled + 1).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        edge(F.col("bin") - 1).alias("low"),
        edge(F.col("bin")).alias("high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("count"),
    )


def box_plot_stats(df: DataFrame, features: Sequence[str] = S.PROFILE_FEATURES, exact: bool = True) -> DataFrame:
    """Quartiles, whisker ends and outlier count of every feature, one row each.

    Whiskers end at the furthest value within 1.5 interquartile ranges of the
    box. `exact=False` takes the quartiles from one sketch pass.
    """
    features = list(features)
    marks = [0.25, 0.5, 0.75]
    if exact:
        quartiles = exact_quantiles(df, features, marks)
    else:
        sketch = df.agg(*[F.percentile_approx(c, marks, 10_000).alias(c) for c in features]).first()
        quartiles = {c: list(sketch[c] or [None] * len(marks)) for c in features}

    aggregates, rows = [], []
    for i, c in enumerate(features):
        v, (q1, median, q3) = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), quartiles[c]
        if median is None:
            # Nothing to summarise: a row of nulls.
            names = ("q1", "median", "q3", "whisker_low", "whisker_high")
            empty = [F.lit(None).cast("double").alias(x) for x in names]
            rows.append(F.struct(F.lit(c).alias("feature"), *empty, F.lit(0).cast("bigint").alias("outliers")))
            continue
        low, high = F.lit(q1 - 1.5 * (q3 - q1)), F.lit(q3 + 1.5 * (q3 - q1))
        aggregates += [
            F.min(F.when(v >= low, v)).alias(f"lo{i}"),
            F.max(F.when(v <= high, v)).alias(f"hi{i}"),
            F.count_if((v < low) | (v > high)).alias(f"out{i}"),
        ]
        # A whisker never ends inside the box.
        rows.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(q1).alias("q1"),
                F.lit(median).alias("median"),
                F.lit(q3).alias("q3"),
                F.least(F.col(f"lo{i}"), F.lit(q1)).alias("whisker_low"),
                F.greatest(F.col(f"hi{i}"), F.lit(q3)).alias("whisker_high"),
                F.col(f"out{i}").alias("outliers"),
            )
        )
    return df.agg(*(aggregates or [F.count("*")])).select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, features: Sequence[str] = S.PROFILE_FEATURES) -> DataFrame:
    """Pearson correlation of every ordered pair of features, in long form.

    Pairs with a missing side are left out of that pair's coefficient.
    """
    features = list(features)
    spark = df.sparkSession
    gaps = df.selectExpr(*[f"count_if(`{c}` is null or isnan(`{c}`)) as `{c}`" for c in features]).first()
    if any(gaps):
        return _pairwise_correlation(df, features)
    vectors = assembler(features).transform(df.select(*features))
    matrix = Correlation.corr(vectors, "raw", "pearson").first()[0].toArray()
    cells = [
        (a, b, float(matrix[i, j])) for i, a in enumerate(features) for j, b in enumerate(features)
    ]
    return local_table(spark, [("a", pa.string()), ("b", pa.string()), ("r", pa.float64())], cells)


def _pairwise_correlation(df: DataFrame, features: list[str]) -> DataFrame:
    pairs = list(combinations(features, 2))
    values = {c: F.when(~F.isnan(c), F.col(c)) for c in features}
    row = df.agg(*[F.corr(values[a], values[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in features]
    for i, (a, b) in enumerate(pairs):
        for x, y in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r")))
    return row.select(F.inline(F.array(*cells)))
