"""The corpus pipeline: quality, exact copies, near copies, mixture, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickstrata.llm import exact_dedup, mixing, packing, quality, simhash
from clickstrata.llm.common import Scratch, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return simhash.without_near_copies(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that the sources meet their targets."""
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places all documents in bins."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mixture),
    ("best-fit packing", sequence_packing),
]

# Perplexities and fingerprints can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored for the next."""
    scratch = Scratch(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage-{i}")
        if i:
            scratch.drop(f"stage-{i - 1}")
    return docs
