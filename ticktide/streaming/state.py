"""Lag features by Spark's own keyed state: ticks wait in event-time slots and come out in order.

The state operator is keyed by (symbol, slot), a slot being a short stretch of event time, so a busy symbol is spread over
many keys and tasks. A slot keeps its ticks in the state store until the watermark has passed its end; then a timer
sorts them, emits them with the lags that lie inside the slot, and clears the key. So late ticks find their place as long
as the watermark allows, and the state holds nothing but open slots: a symbol that falls silent leaves none behind.

Only the first ticks of a slot miss lags. Each batch merges them from the slots' edges, a few rows per slot, and from the
last ticks per symbol that the batch before left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ticktide.operators.ordered import ROWS_PER_SEGMENT, lagged
from ticktide.sinks.files import write_batch
from ticktide.streaming.queries import ARRIVAL_ORDER, CARRIED_TICKS, CarriedPrices, usable

TICKS = "event_id bigint, event_time timestamp, price double"
ORDER = ["event_time", "event_id", "price"]
SORTED = f"symbol string, {TICKS}, price_1 double, price_2 double, place bigint, left bigint"


class SortedSlots(StatefulProcessor):
    """Collects the ticks of one (symbol, slot) and emits them in order when the slot is over."""

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ticks = handle.getListState("ticks", TICKS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [tuple(row) for batch in rows for row in batch[["event_id", "event_time", "price"]].itertuples(index=False)]
        self.ticks.appendList([(None if pd.isna(i) else int(i), at.to_pydatetime(), float(price)) for i, at, price in new])
        end = (int(key[1]) + 1) * self.width_ms
        if end not in list(self.handle.listTimers()):
            self.handle.registerTimer(end)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ticks = pd.DataFrame(list(self.ticks.get()), columns=["event_id", "event_time", "price"])
        self.ticks.clear()
        ticks["event_id"] = ticks["event_id"].astype("Int64")
        ticks = ticks.sort_values(ORDER, kind="stable", na_position="first", ignore_index=True)
        ticks.insert(0, "symbol", key[0])
        for back in (1, 2):
            ticks[f"price_{back}"] = ticks["price"].shift(back)
        ticks["place"] = range(len(ticks))
        ticks["left"] = range(len(ticks) - 1, -1, -1)
        yield ticks

    def close(self) -> None:
        pass


def slot_of(at: Column, width_ms: int) -> Column:
    return F.floor(F.unix_millis(at) / width_ms).cast("bigint")


def sorted_slots(ticks: DataFrame, watermark: str, width_ms: int) -> DataFrame:
    """Usable ticks in slots of event time, each with its place from the slot's start and end."""
    timed = usable(ticks).select("symbol", "event_id", "event_time", F.col("price").cast("double").alias("price"))
    slotted = timed.withWatermark("event_time", watermark).withColumn("slot", slot_of(F.col("event_time"), width_ms))
    return slotted.groupBy("symbol", "slot").transformWithStateInPandas(
        SortedSlots(width_ms), SORTED, "append", "eventTime")


def merged_edges(slots: DataFrame, before: DataFrame | None, rows_per_segment: int) -> tuple[DataFrame, DataFrame]:
    """The first ticks of the slots with their lags, and all edges with the ticks carried from the batch before."""
    edges = slots.where((F.col("place") < CARRIED_TICKS) | (F.col("left") < CARRIED_TICKS))
    edges = edges.select("symbol", *ORDER, "place").withColumn("arrival", F.lit(0))
    known = edges if before is None else edges.unionByName(before, allowMissingColumns=True)
    lags = lagged(known, ["symbol"], ARRIVAL_ORDER, "price", {"price_1": 1, "price_2": 2}, rows_per_segment)
    first = lags.where((F.col("arrival") == 0) & (F.col("place") < CARRIED_TICKS))
    return first.select("symbol", *ORDER, "price_1", "price_2"), known.drop("place")


def lag_state_stream(
    ticks: DataFrame, path: str, state: str, checkpoint: str, watermark: str, width_ms: int = 60_000,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataStreamWriter:
    """Lag features of all ticks, in event-time order per symbol, through restarts.

    A tick comes out when the watermark has passed the end of its slot; ``watermark`` says how late ticks may be, later
    ones are dropped and counted in the query's progress. ``state`` holds the last two ticks per symbol.
    """
    carried = CarriedPrices(state)

    def handle(batch: DataFrame, batch_id: int) -> None:
        slots = batch.persist()
        try:
            before = batch.sparkSession.read.parquet(carried.path(batch_id - 1)) if batch_id else None
            first, known = merged_edges(slots, before, rows_per_segment)
            inside = slots.where(F.col("place") >= CARRIED_TICKS).select(first.columns)
            lags = inside.unionByName(first).withColumn("currency_diff", F.col("price_1") - F.col("price_2"))
            write_batch(lags, path, batch_id)
            carried.save(known, batch_id)
        finally:
            slots.unpersist()

    return (
        sorted_slots(ticks, watermark, width_ms)
        .writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).outputMode("append")
    )
