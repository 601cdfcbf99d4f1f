"""Corpus pipeline: from raw documents to encoded training text.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the
columns of ``documents``; the last returns them encoded. A stage's result is written
as Parquet below the session's shared checkpoint folder and read by the next. The mix
adds the number of each copy, by which the copies are encoded apart.

1. quality: documents scored below ``LEAST_SCORE`` by the rule ensemble go. It
   learns from the labels of the stage's own input.
2. exact: of documents equal up to white space that with the smallest id stays.
3. near: of documents linked by word shingles of five words and a similarity of
   0.8 or more that with the smallest id stays.
4. mix: sources are taken to their target weights; a document comes as often as
   the mix takes it, up to twice.
5. encode: ids of each text under merge dropout; copies of a document are numbered
   and segmented apart.

Nulls, empty and repeated rows and empty tables are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import block_names, mixing, near_dups, piece_dropout, rule_ensemble
from orderflow.llm.catalog import LEAST_SCORE, PIECE_MODEL
from orderflow.llm.text import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ensemble = rule_ensemble.fit_ensemble(docs, labels)
    scored = rule_ensemble.scored(docs, ensemble)
    return scored.where(F.col("score") >= LEAST_SCORE).select(COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return block_names.deduplicated(docs).select(COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.without_near_duplicates(docs, near_dups.Near(words=5, percent=80)).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, copy="copy").select(*COLUMNS, "copy")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    number = F.col("copy") if "copy" in docs.columns else F.lit(1).alias("copy")
    rows = docs.select("doc_id", "lang", "source", "text", number)
    return piece_dropout.encoded(rows, PIECE_MODEL, copy="copy").select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids"
    )


STAGES = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("mix", mix),
    ("encode", encode),
]

#: The fitted trees and merge dropout have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a table directory."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
