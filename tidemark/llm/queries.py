"""One query for each operator of this package, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    divergence, exact_dedup, filter_audit, mixing, ngram_lm, packing, quality, simhash, surrogates, token_counts, topk, toxicity, wavelet,
)
from tidemark.llm.common import read


def op1_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    low, high = (F.lit(x).cast("decimal(38,0)") for x in (-(1 << 63), (1 << 63) - 1))
    return found.withColumn("score", F.least(F.greatest("score", low), high).cast("long"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_documents(read(spark, sf_dir, "documents"), path, capacity=2048, end_id=0, ids=False)


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.surrogate_report(read(spark, sf_dir, "documents"), key="tidemark")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(read(spark, sf_dir, "documents"), path, limit=512)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_report(read(spark, sf_dir, "documents"))


def op7_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = wavelet.round_trip(read(spark, sf_dir, "documents"), path, end_id=2)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3.0)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(read(spark, sf_dir, "documents"), shingle=4, bits=4)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(read(spark, sf_dir, "documents"), least_docs=3, ranks=200)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interaction_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scores(read(spark, sf_dir, "documents"), folds=7, fold=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {n: f for n, f in globals().items() if n.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
