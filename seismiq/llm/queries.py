"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seismiq.llm import (bpe, collocations, decontam, filter_audit, iblt, pii, pitman_yor, quality, sharding, simhash, token_counts,
                         warc, wrappers)
from seismiq.llm.common import sha256_hex, table, text_or_empty

VOCABULARY, PIECES = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
SHARD_BYTES = 1 << 20


def encoded(docs: DataFrame) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    both = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       sha256_hex(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
                       sha256_hex(F.col("decoded")).alias("decoded_sha256"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.counted(F.col("base"), n).alias(f"n_{k}") for n, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, sha256_hex(pii.listed(F.col("base"))).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"), F.size("added").cast("long").alias("n_added"),
                        pii.counted(F.col("added"), pii.SECRET).alias("n_secret"), F.size("spans").cast("long").alias("n_spans"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(PIECES), "rb") as f:
        return token_counts.token_counts(table(spark, sf_dir, "documents"), f.read())


def op4_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scores(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op6_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_pii, op3_token_counts, op4_pitman_yor, op5_sharding, op6_wrappers, op7_simhash,
                              op8_quality, op9_fingerprints, op10_decontamination, op11_warc, op12_collocations, op13_filter_audit)
}

SQL: dict[str, str] = {"op5_sharding": sharding.oracle(SHARD_BYTES), "op11_warc": warc.ORACLE,
                       "op12_collocations": collocations.ORACLE, "op13_filter_audit": filter_audit.ORACLE}
