"""Price ticks: parsing, averages and differences to earlier prices. All work on batch and stream alike
unless they need an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ticktide.functions.symbols import base_currency, quote_currency
from ticktide.functions.times import event_rank, hour_start
from ticktide.operators.ordered import ROWS_PER_SEGMENT, lagged
from ticktide.operators.sides import small_side
from ticktide.schemas import TICK

TICK_ORDER = ["event_time", "event_id", "price"]


def parse_ticks(messages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """JSON in a binary ``value`` to typed columns. A message that does not parse stays as a row of nulls."""
    kept = keep or []
    return (
        messages.select(*kept, F.col("value").cast("string").alias("json_string"))
        .select(*kept, F.from_json("json_string", TICK).alias("data"))
        .select(*kept, "data.*")
        .withColumnRenamed("timestamp", "event_time")
    )


def split_symbol(ticks: DataFrame) -> DataFrame:
    return ticks.withColumns({"base": base_currency(F.col("symbol")), "quote": quote_currency(F.col("symbol"))})


def tumbling_avg(ticks: DataFrame, width: str = "1 minute", watermark: str | None = None) -> DataFrame:
    """Average price per symbol and window. On a stream the watermark bounds the state."""
    if watermark:
        ticks = ticks.withWatermark("event_time", watermark)
    return (
        ticks.groupBy(F.window("event_time", width), "symbol")
        .agg(F.avg("price").alias("avg_price"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "symbol",
            "avg_price",
        )
    )


def lag_features(
    ticks: DataFrame,
    order: list[str] | None = None,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """``currency_diff``: previous price minus the one before it, per symbol; null until both exist."""
    back = {"price_1": 1, "price_2": 2}
    with_lags = lagged(ticks, ["symbol"], order or TICK_ORDER, "price", back, rows_per_segment)
    return with_lags.withColumn("currency_diff", F.col("price_1") - F.col("price_2"))


def last_prices(ticks: DataFrame, bucket: str) -> DataFrame:
    """Last price per symbol and bucket, and the last price of the symbol's bucket before."""
    rank = event_rank(F.col("event_time"), F.col("event_id"), F.col("price"))
    last = ticks.groupBy("symbol", bucket).agg(F.max_by("price", rank).alias("last_price"))
    over = Window.partitionBy("symbol").orderBy(bucket)
    return last.withColumn("previous_price", F.lag("last_price").over(over))


def batch_delta(ticks: DataFrame, bucket: str = "hour", previous: DataFrame | None = None) -> DataFrame:
    """``y``: price minus the symbol's last price in its batch before. Batches are event-time hours.

    Only one row per symbol and hour is ordered, so the window stays as small as the calendar. Pass
    ``previous`` (see ``last_prices``) when the ticks come out of a longer plan than it needs.
    """
    bucketed = _bucketed(ticks, bucket)
    if previous is None:
        previous = last_prices(bucketed, bucket)
    before = small_side(previous.select("symbol", bucket, "previous_price"))
    return bucketed.join(before, ["symbol", bucket], "left").withColumn("y", F.col("price") - F.col("previous_price"))


def _bucketed(ticks: DataFrame, bucket: str) -> DataFrame:
    return ticks if bucket in ticks.columns else ticks.withColumn(bucket, hour_start(F.col("event_time")))


def batch_price_stats(ticks: DataFrame, bucket: str = "hour") -> DataFrame:
    """Row count, first and last price of each batch in a single pass."""
    rank = event_rank(F.col("event_time"), F.col("event_id"), F.col("price"))
    return _bucketed(ticks, bucket).groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by("price", rank).alias("first_price"),
        F.max_by("price", rank).alias("last_price"),
    )
