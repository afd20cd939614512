"""The corpus pipeline: documents of known language, one of each near-duplicate group, free of benchmark
passages, mixed to source weights and written in training order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticktide.llm import cgk, crf_lang, mixing, simhash, token_shards
from ticktide.llm.tables import staged, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return crf_lang.accepted(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_component(docs, shingle=3, max_bits=2)


def free_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cgk.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_shards.materialise(docs, token_shards.shards_path(spark))


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", free_of_benchmarks),
    ("mixing sources to target weights", mixed_sources),
    ("token-ID / binary output", training_order),
]

# A conditional random field, XXH64 fingerprints and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{at}")
    return docs
