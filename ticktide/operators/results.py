"""The published results table: one row per batch with its first row's features, prediction and error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticktide.functions.times import epoch_seconds, event_rank, from_epoch
from ticktide.operators.stats import batch_mse
from ticktide.schemas import FEATURE_COLUMNS, RESULTS


def batch_results(predicted: DataFrame, bucket: str = "hour") -> DataFrame:
    """Results rows from rows with features, ``y`` and ``y_hat``; batches without a prediction give none.

    Also carries the unrounded error as ``mse_exact``.
    """
    known = predicted.where(F.col("y_hat").isNotNull())
    rank = event_rank(F.col("event_time"), F.col("event_id"), F.col("y_hat"))
    kept = [*FEATURE_COLUMNS, "y", "y_hat"]
    rows = known.groupBy(bucket).agg(*[F.min_by(name, rank).alias(name) for name in kept], *batch_mse())
    return typed_results(rows.withColumn("time_stamp", epoch_seconds(F.col(bucket))))


def typed_results(rows: DataFrame) -> DataFrame:
    extra = ["mse_exact"] if "mse_exact" in rows.columns else []
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RESULTS], *extra)


def strip_prefix(df: DataFrame, table: str) -> DataFrame:
    """Column names without the ``table.`` prefix that some drivers return."""
    return df.toDF(*[name.removeprefix(f"{table}.") for name in df.columns])


def dated(results: DataFrame) -> DataFrame:
    return results.withColumn("date", from_epoch(F.col("time_stamp")))


def time_bounds(results: DataFrame) -> DataFrame:
    """Earliest and latest result as time stamps."""
    return results.agg(
        from_epoch(F.min("time_stamp")).alias("start_date"), from_epoch(F.max("time_stamp")).alias("end_date")
    )


def in_period(results: DataFrame, start: Column, end: Column) -> DataFrame:
    """Results between two time stamps, both included. Compares the stored seconds, so the filter
    reaches the scan."""
    return results.where(F.col("time_stamp").between(epoch_seconds(start), epoch_seconds(end)))
