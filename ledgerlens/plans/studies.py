"""The analyses from table to report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators import classifiers as C
from ledgerlens.operators import evaluation as E
from ledgerlens.operators import sampling, scaling, thresholds, tuning
from ledgerlens.operators.boosting import BoostedTrees
from ledgerlens.operators.dbscan import dbscan
from ledgerlens.operators.dense_net import DenseNet
from ledgerlens.operators.joins import join_clusters
from ledgerlens.sources import write_parquet

FAMILIES = {**C.FAMILIES, "boosted_trees": BoostedTrees, "dense_net": DenseNet}


def prepare(
    df: DataFrame,
    key: str,
    scaler: str = "standard",
    fit_on: str = "all",
    fraction: float = 0.8,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Scaled train and test parts with key, features and label.

    The scaler sees all rows before the split, as the analyses do;
    `fit_on="train"` keeps the test rows from it.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', not {fit_on!r}")
    seen = df if fit_on == "all" else sampling.train_test_split(df, key, fraction, seed)[0]
    scaled = scaling.scale(df, scaling.fit_scaler(seen, scaler))
    return sampling.train_test_split(
        scaling.label_projection(scaled, key, "features"), key, fraction, seed
    )


def fixed_study(df: DataFrame, key: str, family: str, fit_on: str = "all", **settings) -> DataFrame:
    """Train one classifier with given settings; one row of test metrics."""
    scaler = "minmax" if family == "naive_bayes" else "standard"
    train, test = prepare(df, key, scaler, fit_on)
    model = C.fit(FAMILIES[family](**settings), train)
    return E.classification_report(C.predict(model, test))


def tuned_study(
    df: DataFrame,
    key: str,
    family: str,
    grid: Mapping[str, Sequence] | None = None,
    fit_on: str = "all",
    **settings,
) -> tuple[tuning.Search, DataFrame]:
    """Search the grid by cross-validation on the train part; the search and one row of test metrics."""
    train, test = prepare(df, key, fit_on=fit_on)
    estimator: Estimator = FAMILIES[family](**settings)
    search = tuning.grid_search(
        estimator,
        tuning.GRIDS[family] if grid is None else grid,
        train.withColumn("fold", sampling.fold_column(key, tuning.FOLDS)),
    )
    return search, E.classification_report(C.predict(search.model, test))


def naive_bayes_model(df: DataFrame, key: str, fit_on: str = "all"):
    """Naive Bayes fitted on the rebalanced train part, with the test part."""
    train, test = prepare(df, key, "minmax", fit_on)
    return C.fit(C.naive_bayes(), sampling.undersample(train, key)), test


def naive_bayes_study(
    df: DataFrame, key: str, choose_on: str = "test", grid: Sequence[float] = thresholds.DEFAULT_THRESHOLDS
) -> DataFrame:
    """Rebalance, fit, sweep thresholds; one row: the best threshold and the metrics there.

    The threshold is chosen on the test part, as the analysis does.
    `choose_on="validation"` holds back a quarter of the train part to choose it.
    """
    if choose_on not in ("test", "validation"):
        raise ValueError(f"choose_on must be 'test' or 'validation', not {choose_on!r}")
    train, test = prepare(df, key, "minmax")
    held_out = test
    if choose_on == "validation":
        train, held_out = sampling.train_test_split(train, key, 0.75, "validation")
    model = C.fit(C.naive_bayes(), sampling.undersample(train, key))
    sweep = thresholds.threshold_sweep(C.positive_scores(model, held_out), thresholds=grid)
    best = thresholds.best_threshold(sweep).select("threshold").scalar()
    scored = C.predict_above(C.positive_scores(model, test), best)
    return E.classification_report(scored).withColumn("threshold", best)


def cluster_and_store(
    df: DataFrame,
    key: str,
    path: str,
    features: Sequence[str] = S.MODEL_FEATURES,
    eps: float = 0.3,
    min_pts: int = 10,
) -> None:
    """Cluster the raw, unscaled features and overwrite `path` with (point, component, is_core)."""
    write_parquet(dbscan(df, key, features, eps, min_pts), path)


def anomaly_predictions(labels: DataFrame, clusters: DataFrame, key: str = "id") -> DataFrame:
    """Labels with component and prediction: 1 where the point is in no cluster."""
    joined = join_clusters(labels, clusters.select("point", "component"), key)
    return joined.withColumn("prediction", F.when(F.col("component").isNull(), 1).otherwise(0))


def anomaly_report(labels: DataFrame, clusters: DataFrame, key: str = "id") -> DataFrame:
    """One row: how well "in no cluster" tells the fraud."""
    return E.binary_metrics(anomaly_predictions(labels, clusters, key))
