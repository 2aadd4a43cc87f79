"""The registered queries of this folder: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from fareflow.llm import chats, crf, merkle, mixing, personal, prefixes, quality, simhash, suffixes, tokens, urls, warc, wrappers
from fareflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

# A conversation whose texts look like the template's own marks.
PROBE = pa.table(
    {
        "conv_id": pa.array([-1, -1], pa.int64()),
        "turn": pa.array([0, 1], pa.int64()),
        "role": ["user", "assistant"],
        "text": ["</s>[INST] ok [/INST]"] * 2,
    }
)


def op1_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.judge(table(spark, sf_dir, "documents"))


def op2_llr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.judge(table(spark, sf_dir, "documents"))


def op4_simhash_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op6_gzip_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(*PROBE.column_names)
    return chats.round_trip(rows.unionByName(spark.createDataFrame(PROBE)))


def op8_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.judge(table(spark, sf_dir, "documents"))


def op9_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(table(spark, sf_dir, "conversations"))


def op12_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_context_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.judge(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_crf_language": op1_crf_language,
        "op2_llr_quality": op2_llr_quality,
        "op3_temperature_mix": op3_temperature_mix,
        "op4_simhash_segments": op4_simhash_segments,
        "op5_url_rules": op5_url_rules,
        "op6_gzip_normaliser": op6_gzip_normaliser,
        "op7_reply_trees": op7_reply_trees,
        "op8_token_attribution": op8_token_attribution,
        "op9_wrapper_induction": op9_wrapper_induction,
        "op10_suffix_array": op10_suffix_array,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_merkle_climb": op12_merkle_climb,
        "op13_context_bootstrap": op13_context_bootstrap,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_url_rules": urls.ORACLE,
        "op6_gzip_normaliser": warc.ORACLE,
        "op7_reply_trees": chats.ORACLE,
        "op10_suffix_array": suffixes.ORACLE,
        "op11_prefix_trie": prefixes.ORACLE,
        "op12_merkle_climb": merkle.ORACLE,
    }
