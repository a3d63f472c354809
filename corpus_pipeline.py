"""The corpus pipeline: documents to a deduplicated, clean, mixed and sharded training set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plyscope.llm import decontaminate, langid, mixing, neardup, sharding
from plyscope.llm.common import table
from plyscope.session import land


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or of no language that the corpus names."""
    return langid.keep_identified(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near-duplicates (five-word shingles, 0.8)."""
    return neardup.drop_near_duplicates(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics meet their target weights; where
    these ask for more than there is, documents are repeated."""
    return mixing.sample_mix(docs, repeats=True)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents into eight shards of near-equal bytes."""
    return sharding.shard(docs, n_shards=8)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontamination),
    ("mix", mixture),
    ("shard", shards),
]

#: The stages learn, fit and search step by step, which one SQL statement cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
