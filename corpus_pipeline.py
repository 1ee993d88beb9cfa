"""Documents to training sequences, stage by stage; each stage starts from what the one before wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, mixing, packing, simhash, toxicity
from tidemark.llm.common import read
from tidemark.session import keep


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic; it learns from those of them that have labels."""
    labels = read(spark, sf_dir, "labels")
    chain = toxicity.train(toxicity.labelled(docs, labels), (*toxicity.SEEDS, "toxic"))
    return toxicity.drop_toxic(docs, chain)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each identical text, the one with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=4, bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks, up to three times."""
    return mixing.mixed_documents(docs, weights=(1, 2, 3), most=3.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens; a document that the mix repeats is packed each time."""
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0, ids=False, cached=300_000)


STAGES = [
    ("toxicity", toxic),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

#: Trained models, bit distances and tokenizers have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
