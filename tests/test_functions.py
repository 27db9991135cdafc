import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import METRICS, bisect_right, clock_hour, guarded_ratio, hash_bucket, threshold_label


def test_hash_bucket_is_the_head_of_the_digest(spark):
    got = spark.range(50).select("id", hash_bucket("id", 42).alias("b")).collect()
    for row in got:
        assert row.b == int(hashlib.md5(f"42|{row.id}".encode()).hexdigest()[:8], 16) % 1000


def test_threshold_label_includes_or_excludes_the_limit(spark):
    row = spark.range(1).select(
        threshold_label(F.lit(0.5), 0.5).alias("a"), threshold_label(F.lit(0.5), 0.5, inclusive=False).alias("b")
    ).first()
    assert (row.a, row.b) == (1.0, 0.0)


def test_guarded_ratio(spark):
    row = spark.range(1).select(
        guarded_ratio(F.lit(1), F.lit(4)).alias("a"), guarded_ratio(F.lit(1), F.lit(0)).alias("b")
    ).first()
    assert (row.a, row.b) == (0.25, 0.0)


def test_clock_hour_runs_past_a_day(spark):
    got = spark.createDataFrame([(0.0,), (3599.9,), (3600.0,), (90_000.0,)], "t double").select(clock_hour("t"))
    assert [r[0] for r in got.collect()] == [0, 0, 1, 25]


def test_bisect_right_matches_searchsorted(spark):
    cuts = [i / 100.0 for i in range(1, 100)]
    values = [0.0, 0.005, 0.01, 0.06, 0.5, 0.985, 0.99, 1.0]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(bisect_right("v", cuts)).collect()
    assert [r[0] for r in got] == np.searchsorted(cuts, values, side="right").tolist()


@pytest.mark.parametrize("name, expected", [("euclidean", 5.0), ("manhattan", 7.0), ("chebyshev", 4.0)])
@pytest.mark.parametrize("dims", [2, 6])
def test_metrics_agree_in_both_forms(spark, name, expected, dims):
    metric = METRICS[name]
    pad = [0.0] * (dims - 2)
    df = spark.createDataFrame([([0.0, 0.0, *pad], [3.0, 4.0, *pad])], "a array<double>, b array<double>")
    near = lambda eps: df.select(metric.near(F.col("a"), F.col("b"), dims, eps)).first()[0]
    assert near(expected + 1e-9) and not near(expected - 1e-9)
