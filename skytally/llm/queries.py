"""The registered queries of this subpackage: each operator over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm import (
    boilerplate,
    bpe,
    language,
    negatives,
    neighbours,
    packing,
    passages,
    quality,
    resampling,
    revisits,
    secrets,
    simhash,
    substrings,
)
from skytally.llm.common import short_batches, table
from skytally.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(short_batches(configure(spark)), sf_dir)

    QUERIES[build.__name__] = run
    return build


@query
def op1_suffix_dedup(spark, sf_dir):
    """Every document without the strings of 200 bytes that start anywhere else."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), 200)


@query
def op2_quality(spark, sf_dir):
    """Counts and verdict of every document."""
    return quality.quality(table(spark, sf_dir, "documents"))


@query
def op3_language(spark, sf_dir):
    """Language of every document, learned from those that are not held out."""
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op4_packing(spark, sf_dir):
    """Every document as pieces of sequences of 4096 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, end_id=1, capacity=4096)


@query
def op5_multiprobe(spark, sf_dir):
    """The twenty nearest of all embeddings for each one whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query
def op6_revisits(spark, sf_dir):
    """What each not-modified capture of the pages stands for."""
    found = revisits.resolve(revisits.crawl(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", revisits.header_lines(F.col("headers")))


ORACLES["op6_revisits"] = revisits.ORACLE


@query
def op7_byte_bpe(spark, sf_dir):
    """Every document to token ids and back, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_decode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, digests=True)


@query
def op8_simhash(spark, sf_dir):
    """Fingerprint of every document and the least doc_id its chain of near-duplicates reaches."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0"))).select(
        "doc_id", "fingerprint", "component_id"
    )


@query
def op9_secrets(spark, sf_dir):
    """Every candidate of every document with the forest's probability; the run itself is given as a digest."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "word_index", "run_index", F.length("run").alias("n_chars"), F.sha2("run", 256).alias("run_sha256"), "probability", "is_secret"
    )


@query
def op10_passages(spark, sf_dir):
    """Passages of documents that another document has in about the same words."""
    return passages.passages(table(spark, sf_dir, "documents"))


@query
def op11_resampling(spark, sf_dir):
    """A quarter of the documents of 20 words or more, drawn by their likeness to the benchmark."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_negatives(spark, sf_dir):
    """Ten hard negatives for each of five positives of every hundredth embedding; every seventh label is wrong on purpose."""
    rows = table(spark, sf_dir, "embeddings")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", wrong), F.col("vec_id") % 100 == 0)


ORACLES["op12_negatives"] = negatives.ORACLE


@query
def op13_article(spark, sf_dir):
    """Main text of every page."""
    return boilerplate.extract(table(spark, sf_dir, "pages"))
