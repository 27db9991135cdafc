"""Assembling and scaling the feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S


def assembler(features: Sequence[str] = S.MODEL_FEATURES, output: str = "raw") -> VectorAssembler:
    """Features to one vector; a missing value is an error."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error")


def fit_scaler(
    df: DataFrame, kind: str = "standard", features: Sequence[str] = S.MODEL_FEATURES
) -> PipelineModel:
    """Assemble and scale. `standard`: mean 0, sample deviation 1. `minmax`: range [0, 1]."""
    if kind == "standard":
        scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    elif kind == "minmax":
        scaler = MinMaxScaler(inputCol="raw", outputCol="features")
    else:
        raise ValueError(f"unknown scaler {kind!r}")
    columns = [F.col(c) for c in features]
    return Pipeline(stages=[assembler(features), scaler]).fit(df.select(*columns))


def scale(df: DataFrame, model: PipelineModel) -> DataFrame:
    return model.transform(df).drop("raw")


def label_projection(df: DataFrame, *keep: str, source: str = "Class") -> DataFrame:
    """Keep the named columns and the class as a double called `label`."""
    return df.select(*keep, F.col(source).cast("double").alias("label"))


def text_label(column: str = "Class"):
    """A class read as text, such as "1" or "1.0", as an integer."""
    return F.col(column).cast("double").cast("int")


def scaled_columns(
    scaled: DataFrame, key: str, features: Sequence[str] = S.MODEL_FEATURES
) -> DataFrame:
    """The scaled vector spread over one column per feature."""
    values = vector_to_array("features")
    return scaled.select(key, *[values.getItem(i).alias(c) for i, c in enumerate(features)])
