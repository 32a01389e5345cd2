"""Registered queries of this folder, and their SQL."""

from __future__ import annotations

import public_tokenizers

from . import audit, bpe, decontaminate, exact, jaccard, langid, lm, pii, quality, repeats, secrets, simhash, turns
from .common import documents, small_batches


def op1_bpe(spark, sf_dir):
    return bpe.digests(bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, packed=True))


def op2_exact_dedup(spark, sf_dir):
    from pyspark.sql import functions as F
    g = exact.exact_groups(documents(spark, sf_dir))
    return g.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


def op3_decontaminate(spark, sf_dir):
    return decontaminate.report(decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def op4_quality(spark, sf_dir):
    return quality.predictions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_langid(spark, sf_dir):
    return langid.predictions(documents(spark, sf_dir))


def op6_secrets(spark, sf_dir):
    return secrets.report(secrets.find(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op10_pii(spark, sf_dir):
    return pii.report(pii.find(documents(spark, sf_dir)))


def op5_jaccard_join(spark, sf_dir):
    return jaccard.near_classes(documents(spark, sf_dir))


def op9_lm_scores(spark, sf_dir):
    return lm.predictions(documents(spark, sf_dir))


def op8_suffix_dedup(spark, sf_dir):
    return repeats.report(repeats.repeated(documents(spark, sf_dir)))


def op11_filter_audit(spark, sf_dir):
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_simhash_dedup(spark, sf_dir):
    return simhash.report(simhash.near_classes(documents(spark, sf_dir)))


def op13_conversation_repair(spark, sf_dir):
    small_batches(spark)
    return turns.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_exact_dedup, op3_decontaminate, op4_quality, op5_jaccard_join, op6_secrets, op7_langid, op8_suffix_dedup, op9_lm_scores, op10_pii,
                                op11_filter_audit, op12_simhash_dedup, op13_conversation_repair)}
ORACLES = {"op2_exact_dedup": exact.ORACLE, "op11_filter_audit": audit.ORACLE}
