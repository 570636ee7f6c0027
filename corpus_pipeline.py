"""Documents to training pieces, in five stages.

Each stage takes all that its predecessor kept and returns the columns of
documents; the last returns pieces in place of text. Between stages stands a
written table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ludometry.llm import contamination, language, lines, pieces, simhash
from ludometry.llm.base import scratch, table
from ludometry.llm.queries import PIECES
from ludometry.session import scratch_path
from ludometry.sources.tables import discard

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose letters are, for the most part, of one known language."""
    return language.confident(docs, language.train(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that earlier ones stand for."""
    return lines.cleaned(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group of near duplicates."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own text contains no item of the benchmark."""
    return contamination.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces, which decode to their texts."""
    return pieces.encoded(docs, pieces.Vocabulary.load(PIECES), pieces.Dropout())


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("simhash", dedup_documents),
    ("benchmark", decontaminate),
    ("pieces", encode),
]

# MinHash, union-find and merges have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; a stage's own tables go when its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
