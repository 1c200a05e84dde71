"""Stages that turn raw documents into training data.

Each stage takes what the one before kept and returns the columns of documents; the last returns what a trainer
reads: the pieces of each text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import jaccard, lattice, line_dedup, toxicity, winnowing
from evenkeel.llm.queries import tokenizer_path
from evenkeel.llm.tables import given, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model fitted on the labels does not call toxic."""
    return toxicity.reject(docs, toxicity.train(docs, given(spark, sf_dir, "labels")))


def without_later_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has, or has nearly; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return winnowing.decontaminate(docs, given(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The best segmentations of each document, the best one as ids and the others as changes to it."""
    return lattice.encode(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line dedup", without_later_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("SentencePiece encoding and decoding", pieces),
]

#: Fitted scores and segmentations are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all stages make of the documents of ``sf_dir``."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
