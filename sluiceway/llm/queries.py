"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import (
    byte_bpe,
    exact_dedup,
    filter_audit,
    hilbert_shards,
    line_quality,
    ngram_join,
    ordinal_quality,
    periodic_runs,
    quote_links,
    signature_join,
    source_mix,
    token_counts,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LAW = "rows"
BITS = 6


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    recipe = toxicity.Recipe()
    network = toxicity.fit(*toxicity.training_sample(docs, labels, recipe), recipe, toxicity.class_counts(labels))
    return toxicity.toxicity(docs, network).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.link_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(documents(spark, sf_dir), exact_dedup.fresh_index(spark))


@query
def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_quality.clean_lines(documents(spark, sf_dir).select("doc_id", "text"), with_text=False)
    return judged.select(
        "doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
        "quality.n_repeat_words", "quality.base_failed", "quality.kept", "quality.n_lines",
        "quality.n_failed_lines", "quality.lost_chars")


@query
def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, levels = hilbert_shards.with_levels(documents(spark, sf_dir), bits=BITS)
    placed = hilbert_shards.assign(docs, levels, bits=BITS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    listed = F.array_join(F.transform("ids", lambda one: one.cast("string")), " ")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"))


@query
def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 poor, 1 good but toxic, 2 good. Kept: more likely than not at least 1."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    ratings = labels.where("quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", grade.alias("grade"))
    recipe = ordinal_quality.Recipe()
    counts = ordinal_quality.grade_counts(ratings, recipe)
    model = ordinal_quality.fit(*ordinal_quality.training_sample(docs, ratings, recipe), recipe, counts)
    return ordinal_quality.rate(docs, model).select(
        "doc_id", ordinal_quality.held_out(F.col("doc_id")).alias("held_out"),
        F.col("rating.expected").alias("expected_grade"), F.col("rating.tails")[0].alias("p_at_least_1"),
        F.col("rating.tails")[1].alias("p_at_least_2"), (F.col("rating.tails")[0] >= 0.5).alias("kept"))


@query
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.take(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges = token_counts.Merges.from_file(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    counted = token_counts.token_counts(documents(spark, sf_dir).select("doc_id", "text"), merges)
    return counted.select("doc_id", "tokens.*")


@query
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_classes(documents(spark, sf_dir)).drop("text_hash", "stays")


@query
def op11_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_join.near_classes(documents(spark, sf_dir))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    counters = filter_audit.count_masks(spark, f"{sf_dir}/documents.parquet", labels)
    return filter_audit.report(counters).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of one id in ten get a tail that repeats before they are judged."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = periodic_runs.find_runs(docs, with_text=False, rewrite=periodic_runs.planted)
    runs = F.col("periodic.runs")
    listed = F.transform(runs, lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    best = found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), periodic_runs.strongest(runs).alias("best"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.col("periodic.collapsed_sha256").alias("collapsed_sha256"))
    exponent = F.expr("(1000 * best.length) div best.period")
    return best.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
