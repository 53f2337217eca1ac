"""The corpus pipeline: quality, near-duplicates, benchmark leaks, mixture, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written as Parquet and read again
as the documents of the next. All but the last return the columns of the documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from filmweave.llm import decontam, mixing, quality, sharding, simhash
from filmweave.llm.common import table
from filmweave.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts good."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates by fingerprint, that with the smallest id."""
    return simhash.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``shard`` and ``slot``."""
    return sharding.sharded(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", without_near_duplicates),
    ("benchmark_decontamination", without_benchmark),
    ("mix_sources", mixed_sources),
    ("sharding", shards),
]

#: The classifier, the fingerprints and the edit search can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
