"""Queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import (
    bit_slices,
    block_names,
    disclosure,
    line_runs,
    mixing,
    near_dups,
    period_tiles,
    piece_counts,
    piece_dropout,
    quality_rules,
    rare_first,
    rule_ensemble,
    warc,
)
from orderflow.llm.text import whole

#: Files of public tokenizers.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WORD_VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def sentencepiece_query(spark: SparkSession, sf: str) -> DataFrame:
    return piece_dropout.round_trip(_documents(spark, sf), PIECE_MODEL)


def token_counts_query(spark: SparkSession, sf: str) -> DataFrame:
    return piece_counts.token_counts(_documents(spark, sf), WORD_VOCABULARY)


def line_dedup_query(spark: SparkSession, sf: str) -> DataFrame:
    return line_runs.without_repeated_lines(_documents(spark, sf).select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def exact_dedup_query(spark: SparkSession, sf: str) -> DataFrame:
    return block_names.duplicate_classes(_documents(spark, sf)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def quality_rules_query(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judged(_documents(spark, sf)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def pii_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = disclosure.sanitised(_documents(spark, sf).select("doc_id", "text"))
    counts = [disclosure.of_kind(F.col("base"), k).alias(f"n_{k}") for k in disclosure.PATTERNS]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(disclosure.written(F.col("base")), 256).alias("base_sha256"),
        disclosure.written(F.col("spans")).alias("spans"),
        F.sha2(whole("sanitised"), 256).alias("sanitised_sha256"),
    )


def mixing_query(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_plan(_documents(spark, sf)).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies"
    )


def near_dedup_query(spark: SparkSession, sf: str) -> DataFrame:
    near = near_dups.Near(words=4, percent=80)
    return near_dups.near_duplicates(_documents(spark, sf), near).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


#: Documents that score less are rejected.
LEAST_SCORE = 0.7


def quality_classifier_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ensemble = rule_ensemble.fit_ensemble(docs, labels)
    return rule_ensemble.scored(docs.select("doc_id", "text"), ensemble).select(
        "doc_id",
        rule_ensemble.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"),
    )


def warc_query(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    return warc.round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def periodic_runs_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = period_tiles.with_planted_periods(_documents(spark, sf).select("doc_id", "text"))
    rows = period_tiles.periodic_runs(docs).withColumn("best", period_tiles.strongest(F.col("runs")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(period_tiles.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def ngram_join_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf).select("doc_id", "text")
    return rare_first.joined(docs, rare_first.Join(words=4, percent=85))


def whitening_query(spark: SparkSession, sf: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    return bit_slices.whitened(vectors)


def queries() -> dict[str, Query]:
    return {
        "op1_sentencepiece": sentencepiece_query,
        "op2_token_counts": token_counts_query,
        "op3_line_dedup": line_dedup_query,
        "op4_exact_dedup": exact_dedup_query,
        "op5_quality_rules": quality_rules_query,
        "op6_pii": pii_query,
        "op7_mixing": mixing_query,
        "op8_near_dedup": near_dedup_query,
        "op9_quality_classifier": quality_classifier_query,
        "op10_warc": warc_query,
        "op11_periodic_runs": periodic_runs_query,
        "op12_ngram_join": ngram_join_query,
        "op13_whitening": whitening_query,
    }
