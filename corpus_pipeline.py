"""The training-data pipeline: from documents to packed sequences, one operator of tallyloom.llm a stage.

Language identification takes out documents without a known language, toxicity the toxic ones, near-dedup all of each
class of near duplicates but one; packing then deals what is left into sequences. Each stage is written as Parquet and
read again, so a lost executor costs no more than the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import language, near_dedup, packing, toxicity
from tallyloom.llm.shared import cut, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.known_language(docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("toxicity", not_toxic), ("near_dedup", near_duplicates), ("packing", pack)]

#: Kernels, classifier chains, signatures and tokenizers are beyond SQL: tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
