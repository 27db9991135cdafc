"""The corpus pipeline: five stages over `documents`, each stored before the next one reads it.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import leaks, mixing, near_copies, quality, queries, tokens
from ledgerlens.llm.columns import column
from ledgerlens.sources import Scratch


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality is one half or more."""
    labels = queries.table(spark, sf_dir, "labels")
    scored, names = quality.quality(docs, labels, Scratch(spark, "quality"))
    return scored.filter(F.col(names[-1]) >= 0.5).select(*(column(scored, c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; rows that share an id but not a group all stay."""
    return near_copies.one_of_each(docs, Scratch(spark, "near-copies"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.without_leaks(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources reads them."""
    mixed, _ = mixing.mix(docs, Scratch(spark, "mixing"))
    return mixed.select(*(column(mixed, c) for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the mixture as token records and return what a reader finds in them."""
    files = tokens.write_token_shards(docs, queries.tokenizer_path(), Scratch(spark, "tokens"), end_id=0)
    return tokens.read_token_shards(spark, files).drop("shard")


STAGES = [
    ("quality_classifier", reject_poor),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("temperature_mixing", mix_sources),
    ("token_output", encode),
]

# SQL has no tokenizer and no trained classifier, so it can't give these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, handing over through Parquet tables."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
