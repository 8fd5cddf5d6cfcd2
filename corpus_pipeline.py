"""Training-corpus pipeline: five stages over ``documents``, each written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seismiq.llm import decontam, pii, quality, simhash
from seismiq.llm.common import materialise, table
from seismiq.llm.queries import encoded


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a test item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, encoded and decoded again."""
    return encoded(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("byte_level_bpe", bpe_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
