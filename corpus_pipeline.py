"""Corpus pipeline: five stages over ``documents``, each calling one operator.

A stage takes (spark, docs, sf_dir), works on all that its predecessor kept,
and returns the columns of ``documents``; the last returns the packing.  Each
result is written as Parquet and reread, so a stage can be repeated alone.

Rows with a null id stay until packing; repeated rows are one document from the
near-duplicate stage on.  An empty table gives an empty packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm.common import stored, table
from cohortlens.llm.jaccard_join import one_of_each
from cohortlens.llm.language_id import accepted
from cohortlens.llm.packing import best_fit
from cohortlens.llm.substring_dedup import without_repeats
from cohortlens.llm.templates import uncontaminated


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told (PPM); the others are rejected."""
    return accepted(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the smallest id."""
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words that an earlier one has."""
    return without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins of what is left."""
    return best_fit(docs)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: PPM code lengths and best-fit packing have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
