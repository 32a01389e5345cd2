"""The corpus pipeline: five filters and encoders, each over all that its predecessor kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from asterion.llm import bpe, decontaminate, exact, jaccard, quality
from asterion.llm.common import small_batches
from asterion.storage import shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    small_batches(spark)
    return exact.keep_one(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words, similarity 0.8."""
    small_batches(spark)
    return jaccard.keep_one(docs, n=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    small_batches(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    small_batches(spark)
    return bpe.digests(bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, packed=True))


STAGES = [("quality", quality_classifier), ("exact_dedup", exact_dedup), ("jaccard_join", jaccard_join),
          ("decontaminate", benchmark_decontamination), ("bpe", encode)]

#: No SQL can express the classifier; tests compare every other stage with a plain version on rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
