"""Histograms, exact quantiles and errors."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ticktide.session import stage

EXACT_ROWS = 1_000_000
QUANTILE_ACCURACY = 100_000


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in equal bins between minimum and maximum; the last bin is closed, empty bins count 0."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return _binned(df, column, low, high, bins)


def histogram_auto(df: DataFrame, column: str, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """As ``histogram``, with the smaller bin width of Sturges and Freedman-Diaconis."""
    values = df.where(F.col(column).isNotNull())
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n:
        return _binned(df, column, low, high, 1)
    lower, upper = quantiles(values, column, [0.25, 0.75], rows=n, exact_rows=exact_rows)
    return _binned(df, column, low, high, auto_bins(float(high) - float(low), n, upper - lower))


def auto_bins(span: float, n: int, spread: float) -> int:
    """Number of bins for a value span, a row count and an interquartile range."""
    if span == 0:
        return 1
    width = span / (math.log2(n) + 1)
    if spread > 0:
        width = min(width, 2 * spread / n ** (1 / 3))
    return max(1, math.ceil(span / width))


def _binned(df: DataFrame, column: str, low, high, bins: int) -> DataFrame:
    if low is None:
        return df.sparkSession.createDataFrame([], "bin bigint, bin_start double, bin_end double, count bigint")
    low, high = float(low), float(high)
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    position = F.least(F.width_bucket(F.col(column).cast("double"), F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    counted = df.where(F.col(column).isNotNull()).groupBy(position.cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    every = df.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")
    return every.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + (F.col("bin") - 1) * F.lit(step)).alias("bin_start"),
        (F.lit(low) + F.col("bin") * F.lit(step)).alias("bin_end"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def quantiles(
    df: DataFrame, column: str, probabilities: list[float], rows: int, exact_rows: int = EXACT_ROWS
) -> list[float]:
    """Exact quantiles with linear interpolation, without sorting the table.

    The exact ``percentile`` aggregate keeps every distinct value in one task. Here only distinct values
    around the wanted ranks are ordered: approximate quantiles bracket a rank, counts prove the bracket.
    """
    places = [p * (rows - 1) for p in probabilities]
    ranks = sorted({rank for place in places for rank in (math.floor(place), math.ceil(place))})
    values = df.select(F.col(column).cast("double").alias("v"))
    if rows <= exact_rows:
        at = _values_at(values, ranks)
    else:
        at, found = {}, _brackets(values, ranks, rows, exact_rows)
        near = stage(values.where(reduce(or_, [F.col("v").between(low, high) for low, high, _, _ in found.values()])))
        for rank, (low, high, below, inside) in found.items():
            part, place = _narrowed(near.where(F.col("v").between(low, high)), rank - below, inside, exact_rows)
            at[rank] = _values_at(part, [place])[place]
    return [
        at[math.floor(place)] + (at[math.ceil(place)] - at[math.floor(place)]) * (place - math.floor(place))
        for place in places
    ]


def _values_at(values: DataFrame, ranks: list[int]) -> dict[int, float]:
    """Values at 0-based ranks. Equal values are one row, whatever their number."""
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = values.groupBy("v").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(upto))
    row = counted.agg(
        *[F.min(F.when(F.col("upto") > rank, F.col("v"))).alias(f"r{rank}") for rank in ranks]
    ).first()
    return {rank: row[f"r{rank}"] for rank in ranks}


def _brackets(
    values: DataFrame, ranks: list[int], rows: int, exact_rows: int
) -> dict[int, tuple[float, float, int, int]]:
    """For each rank two values around it, the number of rows below them and that between them.

    One aggregate estimates all brackets and a second one counts them. A bracket that missed its rank is
    opened on that side and counted again.
    """
    accuracy = min(QUANTILE_ACCURACY, max(exact_rows // 8, 100))
    margin = 2.0 / accuracy
    ends = [min(1.0, max(0.0, rank / (rows - 1) + side)) for rank in ranks for side in (-margin, margin)]
    found = values.agg(F.percentile_approx("v", ends, accuracy)).first()[0]
    bounds = {rank: [found[2 * at], found[2 * at + 1]] for at, rank in enumerate(ranks)}
    while True:
        counts = values.agg(*[
            count for low, high in bounds.values()
            for count in (F.count_if(F.col("v") < low), F.count_if(F.col("v").between(low, high)))
        ]).first()
        known = {rank: (*bounds[rank], counts[2 * at], counts[2 * at + 1]) for at, rank in enumerate(bounds)}
        missed = [rank for rank, (_, _, below, inside) in known.items() if not below <= rank < below + inside]
        if not missed:
            return known
        for rank in missed:
            bounds[rank][rank >= known[rank][2]] = math.inf if rank >= known[rank][2] else -math.inf


def _narrowed(values: DataFrame, rank: int, rows: int, exact_rows: int) -> tuple[DataFrame, int]:
    """The part of ``values`` around a rank that is small enough to order, and the rank inside it."""
    while rows > exact_rows:
        low, high, below, inside = _brackets(values, [rank], rows, exact_rows)[rank]
        if inside == rows:
            break
        values, rank, rows = values.where(F.col("v").between(low, high)), rank - below, inside
    return values, rank


def batch_mse() -> list[Column]:
    """Aggregates: mean squared error as the published whole number (half to even), and exact."""
    error = F.avg(F.pow(F.col("y") - F.col("y_hat"), 2))
    return [F.bround(error, 0).alias("mse"), error.alias("mse_exact")]
