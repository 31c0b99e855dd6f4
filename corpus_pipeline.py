"""Training-data pipeline over `documents`: each stage's Parquet is the next one's input.

Rows that the quality rules reject go; one document of each near-duplicate group stays;
benchmark passages are cut out and texts that are mostly benchmark go; secrets are masked;
what is left is packed into token sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayledger.llm import contamination, neardup, packing, quality, secrets
from dayledger.llm.queries import TOKENIZER
from dayledger.llm.scratch import Scratch, small_batches


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.filter_quality(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return neardup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return contamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return secrets.redact_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, TOKENIZER, limits=packing.SEQUENCE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("minhash_dedup", minhash_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenisation has no SQL form; the tests hold the stages against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    keep = Scratch(docs)
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
