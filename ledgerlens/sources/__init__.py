"""Reading, writing and hand-over tables."""

from ledgerlens.sources.local import local_table
from ledgerlens.sources.scratch import Scratch
from ledgerlens.sources.transactions import (
    preview,
    read_csv,
    read_csv_text,
    read_feature_arrays,
    read_parquet,
    spread_rows,
    write_parquet,
)

__all__ = [
    "Scratch",
    "local_table",
    "preview",
    "read_csv",
    "read_csv_text",
    "read_feature_arrays",
    "read_parquet",
    "spread_rows",
    "write_parquet",
]
