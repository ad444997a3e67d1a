"""The corpus pipeline: language ID, line dedup, near dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and reread as the next one's
documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination, language_id, line_dedup, near_dedup, pieces
from millrace.llm.common import settle, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those that the centroids reject go."""
    return language_id.accepted(docs)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs; those left empty by it go."""
    return line_dedup.without_repeats(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def untested(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of ``benchmark``."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, round_trip."""
    return pieces.tokens(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", fresh_lines),
    ("near_dedup", one_of_each),
    ("decontamination", untested),
    ("encoding", encoded),
]

#: No SQL states the language model, the MinHash index or the piece model. Tests hold the operators to brute force where they
#: have one; of the stages together they check subsets, columns and counts only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
