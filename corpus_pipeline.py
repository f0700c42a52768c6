"""The corpus pipeline: quality rules, near-dedup, substring dedup, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mapweave.llm import fertility, packing, shared, simhash, substrings
from mapweave.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base rules and the fertility bands."""
    return fertility.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near duplicates."""
    return simhash.without_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have."""
    return substrings.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in training sequences."""
    return packing.packed(docs, VOCABULARY)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", pack)]

#: Fingerprints, passages and packing can't be said in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
