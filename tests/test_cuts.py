"""First cuts of a tree against a search of all cuts, and against the tree that Spark fits."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import cuts


def brute(values, labels, kind):
    def impurity(part):
        p = sum(part) / len(part)
        return 2 * p * (1 - p) if kind == "gini" else -sum(x * math.log2(x) for x in (p, 1 - p) if x)

    best, seen = None, sorted(set(values))
    for a, b in zip(seen, seen[1:]):
        sides = [[c for v, c in zip(values, labels) if (v <= a) == low] for low in (True, False)]
        gain = impurity(labels) - sum(len(s) / len(labels) * impurity(s) for s in sides)
        if best is None or gain > best[1] + 1e-12:
            best = ((a + b) / 2, gain, len(sides[0]), len(sides[1]))
    return best


@pytest.mark.parametrize("kind", ["gini", "entropy"])
def test_best_cut_is_that_of_a_search_and_of_the_tree(spark, blobs, kind):
    even = blobs.withColumn("label", F.expr("cast(a + b > 0 as double)"))
    binned = cuts.levels(even, ["label"], list("abcd"), bins=8).cache()
    got = {r.feature: r for r in cuts.best_cuts(binned, list("abcd"), "label", kind).collect()}
    rows = binned.toPandas()
    for c in "abcd":
        cut, gain, below, above = brute(rows[c].tolist(), rows.label.astype(int).tolist(), kind)
        assert (got[c].cut, got[c].below, got[c].above) == (cut, below, above) and abs(got[c].gain - gain) < 1e-12
    root = cuts.fitted_cut(binned, list("abcd"), "label", kind).first()
    best = max(got.values(), key=lambda r: r.gain)
    assert (root.feature, root.cut) == (best.feature, best.cut) and abs(root.gain - best.gain) < 1e-9


def test_levels_and_cuts_of_odd_columns(spark):
    nan = float("nan")
    rows = pd.DataFrame({"a": [0.0, 1.0, 2.0, nan, None, 4.0], "b": [3.0] * 6, "c": [None] * 6, "label": [0.0, 0.0, 1.0, 1.0, 1.0, None]})
    table = spark.createDataFrame(rows.astype(object).where(rows.notna(), None), "a double, b double, c double, label double")
    binned = cuts.levels(table, ["label"], list("abc"), bins=4)
    assert [r.a for r in binned.collect()] == [0.0, 1.0, 2.0, None, None, 3.0]
    assert {r.b for r in binned.collect()} == {0.0} and {r.c for r in binned.collect()} == {None}
    (only,) = cuts.best_cuts(binned, list("abc"), "label").collect()
    assert (only.feature, only.cut, only.below, only.above) == ("a", 1.5, 2, 1)
    assert cuts.best_cuts(binned.limit(0), list("abc"), "label").count() == 0
    with pytest.raises(ValueError):
        cuts.best_cuts(binned, ["a"], "label", "variance")


def test_tree_that_does_not_cut(spark):
    table = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "a double, label double")
    assert cuts.fitted_cut(table, ["a"], "label").count() == 0
