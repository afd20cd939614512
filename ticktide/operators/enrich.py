"""Ticks meet the latest known hourly context (weather and sentiment)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ticktide.functions.times import hour_start
from ticktide.operators.asof import asof_merge
from ticktide.operators.ordered import ROWS_PER_SEGMENT, carried_forward
from ticktide.operators.sides import small_side
from ticktide.operators.ticks import batch_delta, lag_features, last_prices
from ticktide.schemas import CITIES, FEATURE_COLUMNS, MEASURES, WEATHER_COLUMNS

CONTEXT_COLUMNS = [*WEATHER_COLUMNS, "sentiment"]


def hours_of(ticks: DataFrame) -> DataFrame:
    return ticks.select(hour_start(F.col("event_time")).alias("hour")).where(F.col("hour").isNotNull()).distinct()


def context_series(flat_weather: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Hourly observations as (hour, series, value), one series per later column."""
    city = F.coalesce(*[F.when(F.col("country") == code, city) for code, (city, _) in CITIES.items()])
    measures = [
        F.struct(F.concat(F.lit(f"{prefix}_"), city).alias("series"), F.col(source).cast("double").alias("value"))
        for prefix, source in MEASURES.items()
    ]
    weather = flat_weather.where(F.col("country").isin(*CITIES)).select("hour", F.inline(F.array(*measures)))
    moods = sentiment.select("hour", F.lit("sentiment").alias("series"), F.col("sentiment").alias("value"))
    return weather.unionByName(moods)


def forward_fill_hour(hours: DataFrame, series: DataFrame, names: list[str]) -> DataFrame:
    """Value of every series at every hour: observed, or the last one observed before, or null.

    Each group is one series with a few rows per calendar hour, so its size is bounded by the calendar
    whatever the volume of ticks; the series fill in parallel.
    """
    asked = F.array(*[F.struct(F.lit(name).alias("series"), F.lit(True).alias("asked")) for name in names])
    points = series.withColumn("asked", F.lit(False)).unionByName(
        hours.select("hour", F.inline(asked)), allowMissingColumns=True
    )
    # An asked hour stands behind the observations of the same hour.
    filled = carried_forward(points, ["series"], ["hour", "asked", "value"], "value")
    return filled.where(F.col("asked")).drop("asked")


def forward_fill_ranges(
    hours: DataFrame, series: DataFrame, names: list[str], rows_per_range: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """As ``forward_fill_hour`` for series of any length: hours and observations meet in ranges of bounded size."""
    asked = hours.select("hour", F.explode(F.array(*[F.lit(name) for name in names])).alias("series"))
    observed = series.where(F.col("value").isNotNull())
    return asof_merge(asked, observed, ["series"], "hour", ties=["value"], rows_per_range=rows_per_range)


def hourly_context(hours: DataFrame, flat_weather: DataFrame, sentiment: DataFrame) -> DataFrame:
    """One row per hour with the 15 weather columns and the sentiment, gaps filled."""
    filled = forward_fill_hour(hours, context_series(flat_weather, sentiment), CONTEXT_COLUMNS)
    return filled.groupBy("hour").pivot("series", CONTEXT_COLUMNS).agg(F.max("value"))


def asof_hour_join(
    ticks: DataFrame, flat_weather: DataFrame, sentiment: DataFrame, hours: DataFrame | None = None
) -> DataFrame:
    """Each tick with the context of its hour, or of the last hour before that has any.

    The context has one row per hour in ``hours`` (default: the ticks' own), so it is broadcast; if its
    counted size ever forbids that, AQE splits a crowded hour of the shuffled join.
    """
    keyed = ticks if "hour" in ticks.columns else ticks.withColumn("hour", hour_start(F.col("event_time")))
    context = hourly_context(hours_of(ticks) if hours is None else hours, flat_weather, sentiment)
    return keyed.join(small_side(context), "hour", "left")


def feature_table(
    ticks: DataFrame,
    flat_weather: DataFrame,
    sentiment: DataFrame,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """The model's input: 17 features and the target ``y`` for every tick."""
    keyed = ticks.withColumn("hour", hour_start(F.col("event_time")))
    lags = lag_features(keyed, rows_per_segment=rows_per_segment)
    targets = batch_delta(lags, previous=last_prices(keyed, "hour"))
    return asof_hour_join(targets, flat_weather, sentiment, hours_of(ticks)).select(
        "event_id", "symbol", "event_time", "hour", "price", *FEATURE_COLUMNS, "y"
    )


def complete(features: DataFrame) -> DataFrame:
    """Rows a model can use: every feature and the target known."""
    return features.dropna(subset=[*FEATURE_COLUMNS, "y"])


def feature_vector(features: DataFrame) -> DataFrame:
    """The 17 features as one array, in column order."""
    return features.withColumn("x", F.array(*[F.col(name).cast("double") for name in FEATURE_COLUMNS]))
