"""From raw documents to encoded training text, as five stages.

Each stage gets what the one before it kept, written as Parquet and read again. Stages but
the last return the columns of ``documents``; a document that the mix takes twice is two
rows. The last one adds the token ids and their number to the id and source.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import byte_bpe, exact_dedup, line_quality, ngram_join, source_mix
from sluiceway.llm.shared import written

#: SQL cannot express similarity classes or byte pair merges; tests compare with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that fail or lose too much."""
    return line_quality.keep_clean(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, by an index that this run fills."""
    return exact_dedup.keep_first(docs, exact_dedup.fresh_index(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return source_mix.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a check that they decode to its text."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = byte_bpe.encode(docs.select("doc_id", "source", F.col("text").alias("text")), ranks, public_tokenizers.PATTERN)
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (byte_bpe.decode(F.col("ids"), ranks) == whole).alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules), ("exact dedup", exact), ("n-gram Jaccard join", near),
    ("source mix", mix), ("byte-level BPE", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
