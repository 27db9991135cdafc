import numpy as np
import pandas as pd
import pytest

from ledgerlens.operators import profile
from ledgerlens.operators.quantiles import exact_quantiles
from ledgerlens.operators.ranking import row_index


def _doubles(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def _counts(spark, values, bins=10):
    return [r["count"] for r in profile.histogram(_doubles(spark, values), "x", bins).orderBy("bin").collect()]


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    assert _counts(spark, [0, 0, 0, 0, 0.5, 9.5, 10]) == [5, 0, 0, 0, 0, 0, 0, 0, 0, 2]


def test_histogram_of_one_value(spark):
    assert _counts(spark, [3, 3, 3]) == np.histogram([3, 3, 3])[0].tolist()


def test_histogram_matches_numpy(spark):
    values = np.random.default_rng(1).exponential(50, 500).round(2)
    assert _counts(spark, values) == np.histogram(values)[0].tolist()


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles_match_numpy(spark, seed):
    random = np.random.default_rng(seed)
    frame = pd.DataFrame(
        {
            "smooth": random.normal(size=301),
            "steps": random.integers(0, 4, 301).astype(float),
            "flat": np.full(301, 2.5),
            "wild": np.where(random.random(301) < 0.3, 1e9, random.normal(size=301)),
        }
    )
    got = exact_quantiles(spark.createDataFrame(frame), list(frame), [0.0, 0.1, 0.25, 0.5, 0.75, 1.0])
    for c in frame:
        assert got[c] == pytest.approx(np.quantile(frame[c], [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]), rel=1e-12)


def test_box_plot(spark):
    values = [1.0, 2, 3, 4, 5, 6, 7, 8, 9, 100]
    row = profile.box_plot_stats(_doubles(spark, values), ["x"]).first()
    q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (row.q1, row.median, row.q3) == (q1, q2, q3)
    assert (row.whisker_low, row.whisker_high, row.outliers) == (1.0, 9.0, 1)


def test_correlation_matches_pandas_with_and_without_gaps(spark):
    frame = pd.DataFrame(np.random.default_rng(2).normal(size=(60, 3)), columns=list("abc"))
    for holes in (False, True):
        if holes:
            frame.loc[3, "a"] = np.nan
            frame.loc[5:9, "b"] = np.nan
        got = {(r.a, r.b): r.r for r in profile.correlation_matrix(spark.createDataFrame(frame), list("abc")).collect()}
        want = frame.corr()
        assert len(got) == 9
        for (a, b), r in got.items():
            assert r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_class_and_hour_counts(spark):
    df = spark.createDataFrame([(0.0, 0), (10.0, 0), (3700.0, 1), (3800.0, 0)], "Time double, Class int")
    assert [tuple(r) for r in profile.class_distribution(df).collect()] == [("0", 3), ("1", 1)]
    assert {tuple(r) for r in profile.hourly_class_counts(df).collect()} == {(0, 0, 2), (1, 0, 1), (1, 1, 1)}
    assert tuple(profile.row_counts(df).first()) == (4, 1, 3)


def test_row_index_follows_the_key(spark):
    keys = [5, 3, 99, 12, 7, 1]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)
    got = {r.k: r.row_index for r in row_index(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize(
    "values",
    [
        [float(i) for i in range(100)] + [float("nan")],
        [float(i) for i in range(100)] + [float("inf"), float("-inf")],
        [10.0**k for k in range(-300, 301)],
        [-1.7e308, 0.0, 1.7e308, 5.0],
        [float("inf")] * 3,
    ],
)
def test_quartiles_of_extreme_values(spark, values):
    import math

    import numpy as np

    from ledgerlens.operators.quantiles import exact_quantiles

    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [0.25, 0.5])["x"]
    with np.errstate(all="ignore"):
        want = np.quantile([v for v in values if not math.isnan(v)], [0.25, 0.5])
    if len(values) == 3:
        assert got == [math.inf, math.inf]
    else:
        np.testing.assert_allclose(got, want, rtol=1e-12)


@pytest.mark.parametrize("exact", [True, False])
def test_box_plot_of_empty_columns(spark, exact):
    from ledgerlens.operators.profile import box_plot_stats

    df = spark.createDataFrame([(1.0, None), (2.0, None)], "`it's` double, y double")
    rows = {r.feature: r for r in box_plot_stats(df, ["it's", "y"], exact).collect()}
    assert rows["it's"].median is not None and rows["y"].median is None
    assert box_plot_stats(df, ["y"], exact).count() == 1
