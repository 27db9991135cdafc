import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from ledgerlens.operators import evaluation, thresholds
from ledgerlens.plans.studies import anomaly_predictions, anomaly_report


def _pairs(spark, pairs):
    return spark.createDataFrame([(float(p), float(y)) for p, y in pairs], "prediction double, label double")


@pytest.mark.parametrize("pairs", [[(0, 0), (0, 1)], [(1, 0), (0, 0)]])
def test_no_division_by_zero(spark, pairs):
    row = evaluation.classification_report(_pairs(spark, pairs)).first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0) and row.accuracy == 0.5


def test_weighted_f1_is_not_the_fraud_f1(spark):
    df = _pairs(spark, [(0, 0)] * 8 + [(1, 0), (0, 1)] + [(1, 1)] * 2)
    row = evaluation.classification_report(df).first()
    assert row.f1 == pytest.approx(0.6667, abs=1e-4) and row.weighted_f1 == pytest.approx(0.8333, abs=1e-4)
    ours = evaluation.weighted_f1(df).first().weighted_f1
    assert ours == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(df))
    assert row.tp + row.fp + row.fn + row.tn == row.total == 12


def test_missing_cluster_means_anomaly(spark):
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 0), (3, 1)], "id long, label int")
    clusters = spark.createDataFrame([(0, 7), (1, 7)], "point long, component long")
    got = {r.id: r.prediction for r in anomaly_predictions(labels, clusters).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1}
    row = anomaly_report(labels, clusters).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (1, 1, 1, 1)


def _scores(spark, pairs):
    return spark.createDataFrame([(float(s), float(y)) for s, y in pairs], "p1 double, label double")


def test_sweep_matches_brute_force(spark):
    random = np.random.default_rng(3)
    pairs = [(round(s, 2), y) for s, y in zip(random.random(200), random.integers(0, 2, 200))]
    rows = thresholds.threshold_sweep(_scores(spark, pairs)).collect()
    assert len(rows) == 99
    for r in rows:
        tp = sum(s >= r.threshold and y == 1 for s, y in pairs)
        fp = sum(s >= r.threshold and y == 0 for s, y in pairs)
        assert (r.tp, r.fp, r.tp + r.fn, r.total) == (tp, fp, sum(y for _, y in pairs), 200)


def test_lowest_threshold_wins_a_tie(spark):
    sweep = thresholds.threshold_sweep(_scores(spark, [(0.9, 1), (0.1, 0)]))
    best = thresholds.best_threshold(sweep).first()
    assert (best.threshold, best.f1) == (0.11, 1.0)


def test_no_positive_falls_back_to_one_half(spark):
    best = thresholds.best_threshold(thresholds.threshold_sweep(_scores(spark, [(0.9, 0), (0.1, 0)]))).first()
    assert (best.threshold, best.f1) == (0.5, 0.0)
