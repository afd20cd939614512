"""Plot-ready series (date, series, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ticktide.functions.times import from_text
from ticktide.operators.sides import small_side
from ticktide.operators.weather import unpivot_weather


def with_date(ticks: DataFrame, text: str = "timestamp") -> DataFrame:
    return ticks.withColumn("date", from_text(F.col(text)))


def in_time_range(ticks: DataFrame, start: Column, end: Column, at: str = "date") -> DataFrame:
    """Rows between two time stamps, both included, in time order."""
    return ticks.where(F.col(at).between(start, end)).orderBy(at)


def price_series(ticks: DataFrame, every: str | None = None, at: str = "date") -> DataFrame:
    """Prices over time; ``every`` (such as '1 hour') averages them down to a plottable number of points."""
    if every is None:
        return ticks.select(F.col(at).alias("date"), F.lit("Price").alias("series"), F.col("price").alias("value"))
    means = ticks.groupBy(F.window(at, every)).agg(F.avg("price").alias("value"))
    return means.select(F.col("window.start").alias("date"), F.lit("Price").alias("series"), "value")


def m4_series(points: DataFrame, columns: int, at: str = "date", value: str = "value", by: list[str] | None = None) -> DataFrame:
    """The points that draw the same line: per pixel column the first, last, lowest and highest one.

    Time is cut into at most ``columns`` equal pixel columns (whole micros). A line through the up to four points of each
    column covers the same pixels as a line through all points, which means do not. Two aggregates of fixed-width
    numbers, so nothing is sorted: extremes of time and value per column, then the value or time that belongs to each.
    Of points at one time the lowest counts as first and the highest as last. Nulls and NaN are left out.
    """
    by = by or []
    timed = points.select(*by, F.unix_micros(F.col(at).cast("timestamp")).alias("t"), F.col(value).cast("double").alias("v"))
    timed = timed.where(F.col("t").isNotNull() & ~F.isnan(F.coalesce("v", F.lit(float("nan")))))
    low, high = timed.agg(F.min("t"), F.max("t")).first()
    width = 1 if low is None else max(1, -(-(high - low + 1) // columns))
    placed = timed.withColumn("column", F.expr(f"(t - {low or 0}) div {width}"))
    ends = placed.groupBy(*by, "column").agg(
        F.min("t").alias("t0"), F.max("t").alias("t1"), F.min("v").alias("v0"), F.max("v").alias("v1"))
    known = small_side(ends.select(*[F.col(name).alias(f"_{name}") for name in by], F.col("column").alias("_column"), "t0", "t1", "v0", "v1"))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in [*by, "column"]]
    met = placed.join(known, same).groupBy(*by, "column", "t0", "t1", "v0", "v1").agg(
        F.min(F.when(F.col("t") == F.col("t0"), F.col("v"))).alias("first"),
        F.max(F.when(F.col("t") == F.col("t1"), F.col("v"))).alias("last"),
        F.min(F.when(F.col("v") == F.col("v0"), F.col("t"))).alias("lowest"),
        F.min(F.when(F.col("v") == F.col("v1"), F.col("t"))).alias("highest"))
    corners = [("t0", "first"), ("lowest", "v0"), ("highest", "v1"), ("t1", "last")]
    chosen = F.array_distinct(F.array(*[F.struct(F.col(t).alias("t"), F.col(v).alias("v")) for t, v in corners]))
    kind = dict(points.dtypes)[at]
    return met.select(*by, "column", F.inline(chosen)).select(
        *by, "column", F.timestamp_micros("t").cast(kind).alias(at), F.col("v").alias(value))


def prediction_series(results: DataFrame) -> DataFrame:
    named = results.select("date", F.col("y").alias("True"), F.col("y_hat").alias("Prediction"))
    return named.unpivot(["date"], ["True", "Prediction"], "series", "value")


def mse_series(results: DataFrame) -> DataFrame:
    return results.select("date", F.lit("Model MSE").alias("series"), F.col("mse").alias("value"))


def sentiment_series(results: DataFrame) -> DataFrame:
    return results.select("date", F.lit("Sentiment").alias("series"), F.col("sentiment").alias("value"))


def weather_series(results: DataFrame, cities: list[str] | None = None) -> DataFrame:
    return unpivot_weather(results, at="date", cities=cities)
