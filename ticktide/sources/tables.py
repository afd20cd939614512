"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_query(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


def read_results(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
