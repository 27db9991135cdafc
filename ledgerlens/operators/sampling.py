"""Splitting, sampling and rebalancing by hash of the row key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import hash_bucket

_WORD = 2.0**32


def in_train(key: str, fraction: float = 0.8, seed: int = 42) -> Column:
    return hash_fraction(key, seed) < F.lit(float(fraction))


def train_test_split(
    df: DataFrame, key: str, fraction: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test parts that together hold every row."""
    train = in_train(key, fraction, seed)
    return df.filter(train), df.filter(~train)


def fold_column(key: str, folds: int = 3, seed: int | str = "fold") -> Column:
    """Cross-validation fold of a row, 0 .. folds - 1."""
    return hash_bucket(key, seed, folds).cast("int")


def hash_fraction(key: str, seed: int | str) -> Column:
    """A number in [0, 1) that is uniform over keys and fixed for each key."""
    return hash_bucket(key, seed, None).cast("double") / F.lit(_WORD)


def bernoulli_sample(df: DataFrame, key: str, fraction: float | Column, seed: int | str = 42) -> DataFrame:
    """Keep each row with the given probability, without replacement."""
    limit = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return df.filter(hash_fraction(key, seed) < limit)


def class_filter(df: DataFrame, label: str, value: float) -> DataFrame:
    return df.filter(F.col(label) == F.lit(value))


def majority_fraction(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: class counts, and the fraction of negatives that balances them (at most 1)."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )
    ratio = F.col("positives").cast("double") / F.col("negatives").cast("double")
    return counts.withColumn(
        "fraction", F.when(F.col("negatives") > 0, F.least(ratio, F.lit(1.0))).otherwise(F.lit(1.0))
    )


def undersample(
    df: DataFrame, key: str, label: str = "label", seed: int | str = "undersample"
) -> DataFrame:
    """All positives and as many negatives, give or take the sampling, in one filter.

    The seed differs from the split seed: rows of one part of the split share
    a range of that seed's buckets.
    """
    fraction = majority_fraction(df, label).select("fraction").scalar()
    keep = (F.col(label) == 1) | ((F.col(label) == 0) & (hash_fraction(key, seed) < fraction))
    return df.filter(keep)


def undersample_by_union(
    df: DataFrame, key: str, label: str = "label", seed: int | str = "undersample"
) -> DataFrame:
    """The same rows as `undersample`, written as filter, sample and union."""
    fraction = majority_fraction(df, label).select("fraction").scalar()
    negatives = bernoulli_sample(class_filter(df, label, 0), key, fraction, seed)
    return class_filter(df, label, 1).unionByName(negatives)


def sample_exact(df: DataFrame, n: int, key: str, seed: int | str = 42) -> DataFrame:
    """Exactly n rows (all, if there are fewer): those with the smallest key hashes.

    Only rows whose hash lies under a cut-off near n / count get sorted, so the
    sort holds about n rows however large the table is. The cut-off is widened
    until it leaves at least n rows, which keeps the result exact.
    """
    total = df.count()
    rank = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    candidates = df
    if total > n:
        share = (n + 6.0 * math.sqrt(n) + 16.0) / total
        while share < 1.0:
            candidates = df.filter(hash_fraction(key, seed) < F.lit(share))
            if candidates.count() >= n:
                break
            share *= 4.0
            candidates = df
    return candidates.orderBy(rank, F.col(key)).limit(n)
