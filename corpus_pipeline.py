"""Cleaning a corpus in five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and decides about every document that the
stage before it kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

from docweave.llm import stages
from docweave.llm.common import materialise, read
from pyspark.sql import DataFrame, SparkSession


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.7 or more."""
    return stages.reject_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group."""
    return stages.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with benchmark passages."""
    return stages.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by marks of their kind."""
    return stages.redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents by source as the target weights ask, some twice, with a column ``copy``."""
    return stages.mix_sources(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixing", mixing),
]
#: Kernel machines and fingerprints aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
