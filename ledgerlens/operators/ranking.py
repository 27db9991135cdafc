"""Numbering rows in key order without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.sources import Scratch

_PART = "__part"


def row_index(df: DataFrame, key: str, name: str = "row_index", scratch: Scratch | None = None) -> DataFrame:
    """Add the 0-based position of each row in ascending order of a unique key.

    Rows are range-partitioned by key and stored once with their partition
    number, so that the counts and the numbering see the same partitions.
    Each partition is numbered on its own and shifted by the rows before it.
    """
    scratch = scratch or Scratch(df.sparkSession, "row-index")
    parts = scratch.write(
        df.repartitionByRange(F.col(key)).withColumn(_PART, F.spark_partition_id()), "ranges"
    )
    # One row per partition from here on, hence the window without a partition key.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(_PART)
        .agg(F.count("*").alias("rows"))
        .select(_PART, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy(_PART).orderBy(key))
    return (
        parts.join(F.broadcast(offsets), _PART)
        .withColumn(name, (F.col("offset") + within - 1).cast("bigint"))
        .drop(_PART, "offset")
    )
