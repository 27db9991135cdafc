"""Queries against their SQL at the smallest scale, where the tables are present."""

import os

import pandas as pd
import pytest

import __spark_entry__ as entry
from ledgerlens.plans.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"
CHECKED = sorted(ORACLE)

needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_tables
def test_flagship(spark):
    row = entry.entry(spark).first()
    assert row.total == row.tp + row.fp + row.fn + row.tn > 0


@needs_tables
@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    engine = duckdb.connect()
    for table in ("events", "embeddings"):
        engine.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = engine.sql(entry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (t[columns].sort_values(columns).reset_index(drop=True) for t in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
