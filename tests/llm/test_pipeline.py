"""The pipeline's stages on the smallest tables."""

import os

import pytest

import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == names, name
        assert 0 < after.count()
        docs = after
    assert len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.run(spark, FOLDER).count() == docs.count()
