"""Scores of predictions. One conditional aggregate each, no row leaves the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import guarded_ratio


def _with_ratios(counts: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    out = (
        counts.withColumn("total", tp + fp + fn + tn)
        .withColumn("precision", guarded_ratio(tp, tp + fp))
        .withColumn("recall", guarded_ratio(tp, tp + fn))
    )
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", guarded_ratio(2 * p * r, p + r)).withColumn(
        "accuracy", guarded_ratio(tp + tn, "total")
    )


def confusion_counts(prediction: str = "prediction", label: str = "label") -> list[Column]:
    """tp, fp, fn, tn as aggregate columns; class 1 is the positive one."""
    p, y = F.col(prediction), F.col(label)
    return [
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
    ]


def binary_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: confusion counts, then precision, recall and F1 of class 1, and accuracy."""
    return _with_ratios(df.agg(*confusion_counts(prediction, label)))


def classification_report(
    df: DataFrame, prediction: str = "prediction", label: str = "label"
) -> DataFrame:
    """`binary_metrics` plus the label-weighted F1 over both classes."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    f1_positive = guarded_ratio(2 * tp, 2 * tp + fp + fn)
    f1_negative = guarded_ratio(2 * tn, 2 * tn + fp + fn)
    weighted = guarded_ratio(f1_positive * (tp + fn) + f1_negative * (tn + fp), "total")
    return binary_metrics(df, prediction, label).withColumn("weighted_f1", weighted)


def weighted_f1(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: F1 of each class, weighted by how many rows carry that label.

    This is the tuning metric; it is not the F1 of the fraud class.
    """
    confusion = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(
        F.count("*").alias("n")
    )
    hits = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.inline(
        F.array(
            F.struct(
                F.col("y").alias("c"), F.col("n").alias("support"), zero.alias("predicted"), hits.alias("tp")
            ),
            F.struct(
                F.col("p").alias("c"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")
            ),
        )
    )
    per_class = (
        confusion.select(sides)
        .groupBy("c")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
        .withColumn("f1", guarded_ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")))
    )
    return per_class.agg(
        guarded_ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1")
    )
