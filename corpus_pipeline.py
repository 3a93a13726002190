"""A corpus pipeline: quality, language, repeated lines, near copies, packing.

Every stage takes what the one before it kept, as Parquet, and works on all of
it. The first four give documents with the columns of ``documents``; the last
gives the pieces of packed sequences with their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadmason.llm import language_id, line_runs, ngram_join, packing, quality
from loadmason.llm.common import park, small_batches, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language is recognised."""
    small_batches(spark)
    return language_id.keep_identified(docs)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes the later copies of repeated runs of lines."""
    small_batches(spark)
    return line_runs.delete_copies(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that shares 0.8 of its five-word shingles."""
    small_batches(spark)
    return ngram_join.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("language_id", known_language),
    ("line_dedup", fresh_lines),
    ("ngram_jaccard_join", one_of_each),
    ("packing", packed),
]

# The classifiers and the tokenizer are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, one after another."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = park(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
