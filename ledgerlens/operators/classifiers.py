"""The classifier families, with the settings each analysis fixes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml import classification as C
from pyspark.sql import DataFrame, SparkSession

from ledgerlens import schema as S
from ledgerlens.functions import positive_probability, threshold_label
from ledgerlens.sources import local_table

SEED = 42


def linear_svc(**settings) -> C.LinearSVC:
    return C.LinearSVC(**settings)


def decision_tree(**settings) -> C.DecisionTreeClassifier:
    """Depth 5 and 32 bins unless tuned."""
    return C.DecisionTreeClassifier(**{"maxDepth": 5, "maxBins": 32, "seed": SEED, **settings})


def gradient_boosted_trees(**settings) -> C.GBTClassifier:
    return C.GBTClassifier(**{"seed": SEED, **settings})


def logistic_regression(**settings) -> C.LogisticRegression:
    return C.LogisticRegression(**settings)


def multilayer_perceptron(**settings) -> C.MultilayerPerceptronClassifier:
    layers = [len(S.MODEL_FEATURES), 50, 2]
    return C.MultilayerPerceptronClassifier(**{"layers": layers, "seed": SEED, **settings})


def random_forest(**settings) -> C.RandomForestClassifier:
    """500 trees of depth 10."""
    fixed = {"numTrees": 500, "maxDepth": 10, "featureSubsetStrategy": "auto", "seed": SEED}
    # Rows keep their node of every tree instead of walking down from all roots again for each level; the trees are the
    # same. The passes are few whatever the rows, so that their lineage needs no checkpoints.
    kept = {"cacheNodeIds": True, "checkpointInterval": -1}
    return C.RandomForestClassifier(**{**kept, **fixed, **settings})


def naive_bayes(**settings) -> C.NaiveBayes:
    """Multinomial, additive smoothing 1. Needs non-negative features."""
    return C.NaiveBayes(**{"modelType": "multinomial", "smoothing": 1.0, **settings})


FAMILIES = {
    "linear_svc": linear_svc,
    "decision_tree": decision_tree,
    "gradient_boosted_trees": gradient_boosted_trees,
    "logistic_regression": logistic_regression,
    "multilayer_perceptron": multilayer_perceptron,
    "random_forest": random_forest,
    "naive_bayes": naive_bayes,
}


def fit(estimator: Estimator, train: DataFrame) -> Model:
    """Fit on the features and the label alone, so that nothing else is cached or shipped."""
    return estimator.fit(train.select("features", "label"))


def predict(model: Model, rows: DataFrame, *keep: str) -> DataFrame:
    """Batch scoring: the kept columns, the label and the prediction."""
    return model.transform(rows).select(*keep, "label", "prediction")


def positive_scores(model: Model, rows: DataFrame, *keep: str) -> DataFrame:
    """Batch scoring: the kept columns, the label and the probability of class 1 as `p1`."""
    return model.transform(rows).select(*keep, "label", positive_probability().alias("p1"))


def predict_above(scores: DataFrame, threshold, score: str = "p1", inclusive: bool = True) -> DataFrame:
    """Turn scores into predictions at a threshold."""
    return scores.withColumn("prediction", threshold_label(score, threshold, inclusive))


def naive_bayes_parameters(model: C.NaiveBayesModel, features=S.MODEL_FEATURES) -> DataFrame:
    """(label, feature, log_prior, log_likelihood): one row per class and feature."""
    prior, theta = model.pi.toArray(), model.theta.toArray()
    rows = [
        (label, name, float(prior[label]), float(theta[label, j]))
        for label in range(model.numClasses)
        for j, name in enumerate(features)
    ]
    columns = [
        ("label", pa.int32()),
        ("feature", pa.string()),
        ("log_prior", pa.float64()),
        ("log_likelihood", pa.float64()),
    ]
    return local_table(SparkSession.active(), columns, rows)
