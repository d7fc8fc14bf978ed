"""From documents to packed training sequences: five stages, each read back from Parquet by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orevein.llm import exact_dedup, minhash_dedup, mixing, packing, quality
from orevein.plans.tables import table
from orevein.session import Scratch


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.deduplicate(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: five-word shingles, a similarity of 0.8 or more."""
    return minhash_dedup.keep_one(docs, rule=minhash_dedup.WIDER)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("exact dedup", different_documents),
    ("minhash near-dedup", distinct_documents),
    ("source mix", mixed_documents),
    ("best-fit packing", packed_documents),
]

ORACLE_SQL = None  # training, Newton steps and packing are not SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what a stage has read is deleted once its successor is written."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        done = scratch.table(stage(spark, docs, sf_dir), f"stage{number}")
        scratch.drop(docs)
        docs = done
    return docs
