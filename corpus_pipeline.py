"""A corpus pipeline of the operators in sojourn.llm, run stage by stage over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sojourn.llm import common, mixing, near_dedup, packing, quality_rules, substrings


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language's reference go."""
    return quality_rules.apply_quality_rules(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of least id."""
    return near_dedup.deduplicate(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of words that stand elsewhere, too, go from the texts; no document goes."""
    return substrings.dedup_substrings(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to target weights: a document comes as often as was drawn for it, in one shuffled order."""
    return mixing.poisson_mix(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Near-duplicate groups, suffix trees and packing have no plain SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = common.stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
