"""Readers and writers of transaction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = S.TRANSACTIONS,
) -> DataFrame:
    """CSV with a header. A declared schema saves the inference pass; `None` infers."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column left as text."""
    return spark.read.option("header", True).csv(path)


def read_feature_arrays(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str,
    features: Sequence[str] = S.MODEL_FEATURES,
) -> DataFrame:
    """CSV rows as (id, value array): the input form of the clustering job."""
    return feature_arrays(read_csv(spark, path, schema), key, features)


def feature_arrays(df: DataFrame, key: str, features: Sequence[str] = S.MODEL_FEATURES) -> DataFrame:
    """Pack the features of each row into one array, in the order given."""
    return df.select(
        F.col(key).cast("bigint").alias("id"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("value"),
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite `path` with the table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first rows, for looking at."""
    return df.limit(n)


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """Deal a table of few files over all task slots; a table of many is left as it is."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots, key)
