"""Small tables that start on the driver: brackets, grids, reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_table(spark: SparkSession, schema: Sequence[tuple[str, pa.DataType]], rows: Iterable[tuple]) -> DataFrame:
    """Rows as a DataFrame that sits in the plan itself, without a job to load it."""
    fields = pa.schema([pa.field(name, kind) for name, kind in schema])
    names = [name for name, _ in schema]
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=fields))
