"""A labelled transaction table derived from the `events` and `embeddings` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions import hash_bucket
from ledgerlens.sources import spread_rows

KEY = "event_id"
BUCKET = "b"


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Every event with the first 28 numbers of an embedding, its value and a learnable class.

    Buckets under 5 carry the opposite class: half a percent of label noise.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spread_rows(spark.read.parquet(f"{folder}/events.parquet").select(KEY, "ts", "value"), KEY)
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    first = events.agg(F.min(second).alias("s")).scalar()
    size = vectors.agg(F.count("*").alias("n")).scalar()
    joined = events.select(
        KEY,
        hash_bucket(KEY, 42).alias(BUCKET),
        (second - first).cast("double").alias("Time"),
        F.pmod(F.col(KEY), size).alias("vec_id"),
        F.col("value").cast("double").alias("Amount"),
    ).join(vectors, "vec_id")
    spread = joined.select(
        KEY,
        BUCKET,
        "Time",
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(S.COMPONENTS)],
        "Amount",
    )
    rule = ((F.col("V3") + F.col("V7") > 0.25) & (F.col("Amount") > 20.0)).cast("int")
    return spread.withColumn("Class", F.when(F.col(BUCKET) < 5, 1 - rule).otherwise(rule))


def plane_points(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a point of the plane: user by amount."""
    events = spark.read.parquet(f"{folder}/events.parquet").select(KEY, "user_id", "value")
    return spread_rows(events, KEY).select(
        F.col(KEY).alias("id"),
        (F.col("user_id") / F.lit(150.0)).alias("x"),
        (F.col("value") / F.lit(500.0)).alias("y"),
    )


def globe_points(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a place on the globe: latitude by user, longitude by amount."""
    events = spark.read.parquet(f"{folder}/events.parquet").select(KEY, "user_id", "value")
    return spread_rows(events, KEY).select(
        F.col(KEY).alias("id"),
        (F.col("user_id") / F.lit(1.25) - 60).alias("lat"),
        (F.col("value") / F.lit(500.0) * 360 - 180).alias("lon"),
    )
