"""The pipeline over ``documents``: stages by name, each a function of (spark, docs, sf_dir) that returns the next stage's documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import mixing, ngram_join, packing, secret_scan, toxicity
from rollcall.llm.common import kept_table, small_batches, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model learned from ``labels`` calls toxic go."""
    small_batches(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 of their five-word shingles, the one with the smallest id stays."""
    small_batches(spark)
    return ngram_join.one_of_each(docs, words=5, num=80, den=100)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Values of secrets are replaced in the texts; every document stays."""
    small_batches(spark)
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get their shares; documents appear as often as the mix takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: The first stage learns from labels, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return docs
