"""Small Spark helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticktide.session import prepare, scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back, so that a lost executor repeats no earlier work."""
    spark = prepare(df.sparkSession)
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(rows, limit: int):
    """Guard for a table that goes to every task: its documented bound must hold."""
    if len(rows) > limit:
        raise ValueError(f"a model table has {len(rows)} rows, its bound is {limit}")
    return rows


def hashed_sample(rows: DataFrame, draw: str, size: int) -> DataFrame:
    """At most ``size`` rows, those with the smallest of the evenly spread 64-bit hashes in column ``draw``.

    The rows are counted first and cut by a hash limit that leaves somewhat more than ``size`` of them, so that
    neither many rows nor the best rows of every partition come together in one task.
    """
    share = 1.3 * (size + 100) / max(rows.count(), 1)
    if share < 1:
        rows = rows.where(F.col(draw) <= int(-(1 << 63) + share * (1 << 64)))
    return rows.orderBy(draw).limit(size)


def with_largest(rows: DataFrame, value: str, size: int) -> DataFrame:
    """The rows with the largest values, as many whole values as make at most ``size`` rows. Only one row per distinct
    value is ordered."""
    least = _counted(rows, value).where(F.col("__upto") <= size).agg(F.min(value).alias("least")).first()["least"]
    return rows.where(F.lit(False) if least is None else F.col(value) >= least)


def parted(rows: DataFrame, value: str, draw: Column, size: int) -> tuple[DataFrame, DataFrame | None]:
    """At most ``size`` rows with the largest values, and all others, None if there are none. Of the value that does not fit
    as a whole those rows are taken whose evenly spread 64-bit hash ``draw`` is small, somewhat fewer than would fit."""
    if rows.count() <= size:
        return rows, None
    cut = _counted(rows, value).where(F.col("__upto") > size).orderBy(F.desc(value)).first()
    room = size - (cut["__upto"] - cut["__rows"])
    share = max(room - 4 * (room + 1) ** 0.5, 0) / cut["__rows"]
    some = (F.col(value) == cut[value]) & (draw < int(-(1 << 63) + share * (1 << 64)))
    larger = (F.col(value) > cut[value]) | some
    return rows.where(larger), rows.where(~larger)


def _counted(rows: DataFrame, value: str) -> DataFrame:
    """Per distinct value its rows and those of it and all larger ones."""
    counted = rows.groupBy(value).agg(F.count(F.lit(1)).alias("__rows"))
    return counted.withColumn("__upto", F.sum("__rows").over(Window.orderBy(F.col(value).desc())))


def fixpoint(start: DataFrame, step: Callable[[DataFrame], DataFrame], label: str, rounds: int = 60) -> DataFrame:
    """Apply ``step`` until the set of rows stays the same; each round is staged."""
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())

    now, known = start, mark(start)
    for _ in range(rounds):
        now = staged(step(now), label)
        seen = mark(now)
        if seen == known:
            return now
        known = seen
    raise RuntimeError(f"{label}: no fixpoint after {rounds} rounds")
