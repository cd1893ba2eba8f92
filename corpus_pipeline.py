"""A training corpus from raw documents: five stages, each written and read again before the next one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import language, packing, passages, secrets, simhash
from skytally.llm.common import short_batches, stored, table
from skytally.session import configure


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that have no letter or no clear language."""
    return language.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose fingerprints of four-word shingles differ in four bits or fewer."""
    return simhash.keep_first(docs, shingle=4, distance=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of 50 words or more that an earlier document has, and without what is empty then."""
    return passages.cut_passages(docs).withColumn("n_chars", F.length("text").cast("long"))


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With a mark in place of each secret."""
    return secrets.mask(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As pieces of sequences of 4096 tokens. Workers have other stages behind them, so they remember fewer words than alone."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, path, end_id=1, capacity=4096, most_cached=200_000, slice_bytes=1 << 20)


STAGES = [
    ("language_id", known_language),
    ("simhash_dedup", near_duplicates),
    ("passage_dedup", repeated_passages),
    ("secret_scan", masked_secrets),
    ("packing", packed),
]

# Fingerprints, chains, forests and tokenizers have no SQL form; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(short_batches(configure(spark)), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
