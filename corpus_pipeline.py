"""A corpus made ready for training: five stages, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm import decontamination, language_id, ngram_join, packing, secret_scans
from larder.llm.common import documents, kept


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, fitted on their labels, does not reject."""
    return language_id.accepted(docs, language_id.train(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates: five-word shingles, 0.8 alike or more."""
    return ngram_join.firsts(docs, words=5, near=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secret_scans.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences and offsets."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_languages),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scans", without_secrets),
    ("best_fit_packing", packed),
]

# Trained models and a tokenizer decide; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), name)
    return docs
