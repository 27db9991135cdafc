import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import sampling


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("double").alias("label"))


def _keys(df):
    return {r.k for r in df.select("k").collect()}


def test_split_is_a_partition_and_ignores_partitioning(rows):
    train, test = sampling.train_test_split(rows, "k")
    again, _ = sampling.train_test_split(rows.repartition(7), "k")
    assert _keys(train) | _keys(test) == set(range(2000)) and not _keys(train) & _keys(test)
    assert _keys(train) == _keys(again) and 1500 < len(_keys(train)) < 1700


def test_folds_cover_all_rows(rows):
    counts = {r.fold: r["count"] for r in rows.select(sampling.fold_column("k").alias("fold")).groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and sum(counts.values()) == 2000 and min(counts.values()) > 550


def test_exact_sample_size_and_order(rows):
    for n in (1, 137, 2000, 5000):
        assert len(_keys(sampling.sample_exact(rows, n, "k"))) == min(n, 2000)
    assert _keys(sampling.sample_exact(rows, 100, "k")) <= _keys(sampling.sample_exact(rows.repartition(5), 137, "k"))


def test_undersample_keeps_positives_and_balances(rows):
    kept = sampling.undersample(rows, "k")
    counts = {r.label: r["count"] for r in kept.groupBy("label").count().collect()}
    assert counts[1.0] == 200 and 150 < counts[0.0] < 250
    assert _keys(kept) == _keys(sampling.undersample_by_union(rows, "k"))


def test_undersample_clamps_the_fraction(rows):
    few = rows.filter("label = 1 or k < 50")
    assert sampling.majority_fraction(few).first().fraction == 1.0
    assert _keys(sampling.undersample(few, "k")) == _keys(few)
    only = rows.filter("label = 1")
    assert _keys(sampling.undersample(only, "k")) == _keys(only)


@pytest.mark.parametrize("fraction", [0.0004, 0.9996])
def test_split_fractions_are_not_rounded(spark, fraction):
    train, test = sampling.train_test_split(spark.range(100_000).withColumnRenamed("id", "k"), "k", fraction)
    small = train if fraction < 0.5 else test
    assert 15 < small.count() < 80
