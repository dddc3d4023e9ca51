"""The queries of this subpackage, each over whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, decontamination, fill_middle, hard_negatives, language, near_dedup, norm_search, packing, sharding, tool_calls, toxicity, urls, weighted_sampling
from .shared import table


def op1_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_pages(table(spark, sf_dir, "pages"))


def op3_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link_conversations(table(spark, sf_dir, "conversations"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"))


def op6_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(table(spark, sf_dir, "documents"))


def op8_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_search.top_products(table(spark, sf_dir, "embeddings"))


def op9_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_rank_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_classifier_chain": op1_classifier_chain,
        "op2_host_trust": op2_host_trust,
        "op3_bm25_packing": op3_bm25_packing,
        "op4_tool_calls": op4_tool_calls,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_feistel_sharding": op6_feistel_sharding,
        "op7_weighted_sampling": op7_weighted_sampling,
        "op8_norm_buckets": op8_norm_buckets,
        "op9_dart_minhash": op9_dart_minhash,
        "op10_language_kernel": op10_language_kernel,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_positional_index": op12_positional_index,
        "op13_rank_index": op13_rank_index,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    found = {
        "op2_host_trust": urls.ORACLE_SQL,
        "op4_tool_calls": tool_calls.ORACLE_SQL,
        "op8_norm_buckets": norm_search.ORACLE_SQL,
        "op11_hard_negatives": hard_negatives.ORACLE_SQL,
        "op12_positional_index": decontamination.ORACLE_SQL,
        "op13_rank_index": fill_middle.ORACLE_SQL,
    }
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
