"""From raw documents to a training mix: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareflow.llm import crf, mixing, quality, simhash, suffixes
from fareflow.llm.common import free_name, stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are sure of a learned language; others go."""
    return crf.known_only(docs)


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; others go."""
    return quality.good_only(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return suffixes.clean_only(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: one row per document and pass."""
    return mixing.mix(docs, free_name(docs, "mix"))


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", check_quality),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]

# The language model, the hashes of fingerprints and the buckets have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
