"""Hourly weather of the observed cities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ticktide.schemas import CITIES, MEASURES

KELVIN_OFFSET = 273.15
PAIR_MEASURES = ("humidity", "wind_speed", "pressure", "temp", "feels_like")


def flatten_weather(weather: DataFrame) -> DataFrame:
    """City, country, Celsius temperature, humidity and wind speed, next to the hour."""
    return weather.select(
        "hour",
        F.col("name").alias("city_name"),
        F.col("sys.country").alias("country"),
        (F.col("main.temp") - KELVIN_OFFSET).alias("temperature"),
        F.col("main.humidity").alias("humidity"),
        F.col("wind.speed").alias("wind_speed"),
    )


def raw_measures(weather: DataFrame) -> DataFrame:
    """The five numeric measures as read, in Kelvin."""
    return weather.select(
        "main.humidity", F.col("wind.speed").alias("wind_speed"), "main.pressure", "main.temp", "main.feels_like"
    )


def pivot_weather(flat: DataFrame) -> DataFrame:
    """One row per hour with 15 columns, by name: ``tem_paris``, ``hum_paris``, ``wind_paris``, ..."""
    measures = [F.max(F.col(source).cast("double")).alias(prefix) for prefix, source in MEASURES.items()]
    wide = flat.groupBy("hour").pivot("country", list(CITIES)).agg(*measures)
    return wide.select(
        "hour",
        *[
            F.col(f"{country}_{prefix}").alias(f"{prefix}_{city}")
            for country, (city, _) in CITIES.items()
            for prefix in MEASURES
        ],
    )


def unpivot_weather(wide: DataFrame, at: str = "hour", cities: list[str] | None = None) -> DataFrame:
    """Long series (time, measure, city, value), optionally only for chosen cities."""
    chosen = [city for city, _ in CITIES.values() if cities is None or city in cities]
    columns = [f"{prefix}_{city}" for city in chosen for prefix in MEASURES]
    long = wide.unpivot([at], columns, "series", "value")
    return long.select(
        at,
        F.get(F.split("series", "_"), F.lit(0)).alias("measure"),
        F.get(F.split("series", "_"), F.lit(1)).alias("city"),
        "value",
    )


def pair_correlation(measures: DataFrame, columns: tuple[str, ...] = PAIR_MEASURES) -> DataFrame:
    """Correlation of each pair of measures, all from one aggregate."""
    pairs = [(left, right) for at, left in enumerate(columns) for right in columns[at + 1:]]
    once = measures.agg(*[F.corr(left, right).alias(f"{left}|{right}") for left, right in pairs])
    rows = [
        F.struct(F.lit(left).alias("left"), F.lit(right).alias("right"), F.col(f"{left}|{right}").alias("corr"))
        for left, right in pairs
    ]
    return once.select(F.inline(F.array(*rows)))


def pair_grid(measures: DataFrame, columns: tuple[str, ...] = PAIR_MEASURES, bins: int = 10) -> DataFrame:
    """The joint panels of the pair plot: rows per cell of equal bins, for each pair of measures; empty cells are left out.

    Bounds come from one aggregate. Rows are counted once by the cells of all measures together, and only those
    counts are dealt out to the pairs.
    """
    bounds = measures.agg(*[end(name).cast("double").alias(f"{word}_{name}")
                            for name in columns for word, end in (("low", F.min), ("high", F.max))]).first()
    places = []
    for name in columns:
        low, high = bounds[f"low_{name}"], bounds[f"high_{name}"]
        if low is None:
            places.append(F.lit(None).cast("bigint").alias(name))
            continue
        low, high = (low, high) if low < high else (low - 0.5, high + 0.5)
        bin_of = F.width_bucket(F.col(name).cast("double"), F.lit(low), F.lit(high), F.lit(bins))
        places.append(F.when(bin_of.isNotNull(), F.least(bin_of, F.lit(bins))).cast("bigint").alias(name))
    cells = measures.select(*places).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    pairs = [(left, right) for at, left in enumerate(columns) for right in columns[at + 1:]]
    panels = F.array(*[F.struct(F.lit(left).alias("left"), F.lit(right).alias("right"), F.col(left).alias("left_bin"),
                                F.col(right).alias("right_bin")) for left, right in pairs])
    dealt = cells.select("n", F.inline(panels)).dropna(subset=["left_bin", "right_bin"])
    return dealt.groupBy("left", "right", "left_bin", "right_bin").agg(F.sum("n").alias("count"))


def union_weather(frames: list[DataFrame]) -> DataFrame:
    """Frames with drifting schemas, by name, duplicates kept. Reading one directory needs no union."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
