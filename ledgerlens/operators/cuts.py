"""The first cut of a decision tree: class counts over bins, and what a cut between two bins gains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators.scaling import assembler


def levels(df: DataFrame, keep: Sequence[str], features: Sequence[str] = S.MODEL_FEATURES, bins: int = 16) -> DataFrame:
    """The kept columns, and of each feature its bin of equal width, from 0; missing values and NaN stay missing.

    A feature of one single value lies in bin 0.
    """
    values = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in features}
    ends = df.agg(*(f(v).alias(f"{n}_{c}") for c, v in values.items() for n, f in (("lo", F.min), ("hi", F.max)))).first()
    columns = []
    for c, v in values.items():
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        if lo is None or lo == hi:
            level = F.lit(0)
        else:
            level = F.least(F.floor((v - lo) * F.lit(float(bins)) / (F.lit(hi) - F.lit(lo))), F.lit(bins - 1))
        columns.append(F.when(v.isNotNull(), level.cast("double")).alias(c))
    return df.select(*keep, *columns)


def best_cuts(binned: DataFrame, features: Sequence[str] = S.MODEL_FEATURES, label: str = "Class", impurity: str = "gini") -> DataFrame:
    """(feature, cut, gain, below, above): the cut of each feature that gains most, the smallest of equals.

    Rows at most `cut`, which lies midway between two levels that occur, go
    below. `impurity` is "gini" or "entropy". Rows without label, and missing
    values of a feature, are left out; a feature of one level has no row. One
    pass with a row per feature and level after partial aggregation.
    """
    long = binned.filter(F.col(label).isNotNull()).unpivot([label], list(features), "feature", "level")
    counts = long.filter("level IS NOT NULL").groupBy("feature", "level")
    counts = counts.agg(F.count("*").cast("double").alias("n"), F.sum(label).cast("double").alias("p"))
    every = Window.partitionBy("feature")
    upto = every.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tried = counts.select(
        "feature",
        ((F.col("level") + F.lead("level").over(every.orderBy("level"))) / 2).alias("cut"),
        *(F.sum(c).over(w).alias(f"{c}_{name}") for c in "np" for name, w in (("all", every), ("below", upto))),
    ).filter("cut IS NOT NULL")
    tried = tried.withColumn("n_above", F.col("n_all") - F.col("n_below")).withColumn("p_above", F.col("p_all") - F.col("p_below"))
    mixed = {side: _impurity(F.col(f"p_{side}") / F.col(f"n_{side}"), impurity) for side in ("all", "below", "above")}
    left = sum((F.col(f"n_{side}") / F.col("n_all") * mixed[side] for side in ("below", "above")), F.lit(0.0))
    gained = tried.withColumn("gain", mixed["all"] - left)
    # Gains that differ by rounding alone count as equal.
    order = every.orderBy(F.desc(F.round("gain", 12)), "cut")
    best = gained.withColumn("place", F.row_number().over(order)).filter("place = 1")
    return best.select("feature", "cut", "gain", F.col("n_below").cast("long").alias("below"), F.col("n_above").cast("long").alias("above"))


def _impurity(p: Column, kind: str) -> Column:
    if kind == "gini":
        return 1 - p * p - (1 - p) * (1 - p)
    if kind == "entropy":
        return sum((F.when(x > 0, -x * F.log2(x)).otherwise(0.0) for x in (p, 1 - p)), F.lit(0.0))
    raise ValueError(f"unknown impurity {kind}")


def fitted_cut(binned: DataFrame, features: Sequence[str] = S.MODEL_FEATURES, label: str = "Class", impurity: str = "gini") -> DataFrame:
    """(feature, cut, gain) of the root of a fitted decision tree of depth 1; no row where it does not cut."""
    features = list(features)
    rows = assembler(features).transform(binned.select(F.col(label).cast("double").alias("label"), *features))
    tree = DecisionTreeClassifier(featuresCol="raw", maxDepth=1, maxBins=32, impurity=impurity)
    root = tree.fit(rows)._call_java("rootNode")
    cut = "feature string, cut double, gain double"
    if root.subtreeDepth() == 0:
        return binned.sparkSession.createDataFrame([], cut)
    found = (features[root.split().featureIndex()], root.split().threshold(), root.gain())
    return binned.sparkSession.range(1).select(*(F.lit(v).alias(n) for v, n in zip(found, ("feature", "cut", "gain"))))
