"""Lags by keyed state: order, restarts, late ticks, and how much state stays."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ticktide.session import scratch_path
from ticktide.streaming import queries as streams, state

START = dt.datetime(2024, 1, 1)
ROWS = "event_id bigint, symbol string, event_time timestamp, price double, base string, quote string"


def tick(number, symbol, second, price):
    return number, symbol, START + dt.timedelta(seconds=second), price, None, None


def plain(ticks):
    """Lags per symbol in order of time, id and price."""
    result, last = [], {}
    for number, symbol, at, price, *_ in sorted(ticks, key=lambda t: (t[1], t[2], t[0] is not None, t[0] or 0, t[3])):
        two = last.setdefault(symbol, [None, None])
        result.append((number, symbol, price, two[-1], two[-2]))
        two.append(price)
    return sorted(map(repr, result))


def drained(spark, root, batches, width_ms, watermark, rows_per_segment=1000):
    """Each batch is a run of its own, restarted from the checkpoint; progress of the last micro-batches."""
    progress = []
    for batch in batches:
        spark.createDataFrame(batch, ROWS).coalesce(1).write.mode("append").parquet(f"{root}/in")
        ticks = spark.readStream.schema(ROWS).parquet(f"{root}/in")
        query = streams.start(state.lag_state_stream(
            ticks, f"{root}/out", f"{root}/prices", f"{root}/checkpoint", watermark, width_ms, rows_per_segment), drain=True)
        progress.append([p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]])
    return progress


def found(spark, root):
    rows = spark.read.parquet(f"{root}/out").select("event_id", "symbol", "price", "price_1", "price_2").collect()
    return sorted(repr(tuple(row)) for row in rows)


def test_late_ticks_ties_and_restarts(spark):
    rng = random.Random(2)
    ticks = [tick(at if at % 9 else None, "HOT" if at % 3 else f"S{at % 5}", rng.choice([at // 2, at // 20 * 10]), float(rng.randrange(50)))
             for at in range(360)]
    arrival = sorted(ticks, key=lambda t: (t[2] + dt.timedelta(seconds=rng.randrange(30)), str(t)))
    batches = [arrival[:150], arrival[150:300], arrival[300:] + [(None, None, None, None, None, None), tick(5, "HOT", 10 ** 6, 0.0)]]
    root = scratch_path(spark, "state-test")
    progress = drained(spark, root, batches, width_ms=7000, watermark="40 seconds", rows_per_segment=20)
    assert all(p["numRowsDroppedByWatermark"] == 0 for run in progress for p in run)
    assert found(spark, root) == plain(ticks)


def test_closed_slots_leave_no_state_and_later_ticks_are_counted(spark):
    """Symbols that fall silent disappear; ticks behind the watermark change nothing."""
    first = [tick(at, f"S{at % 40}", at % 60, 1.0) for at in range(200)]
    second = [tick(1000 + at, "S1", 600 + at, 2.0) for at in range(5)]
    late = [tick(2000, "S2", 3, 9.0), tick(2001, "S1", 1200, 3.0)]
    root = scratch_path(spark, "state-test")
    progress = drained(spark, root, [first, second, late], width_ms=10_000, watermark="20 seconds")
    assert max(p["numRowsTotal"] for p in progress[0]) >= 100
    assert progress[1][-1]["numRowsTotal"] < 20 and progress[2][-1]["numRowsTotal"] < 20
    assert sum(p["numRowsDroppedByWatermark"] for p in progress[2]) == 1
    assert found(spark, root) == plain(first + second)


def test_a_busy_symbol_is_spread_over_slots(spark):
    ticks = spark.range(1000).select(F.timestamp_millis(F.col("id") * 100).alias("at"))
    assert ticks.select(state.slot_of(F.col("at"), 1000).alias("slot")).distinct().count() == 100
    edges = spark.range(1000).select(
        F.lit("HOT").alias("symbol"), F.col("id").alias("event_id"), F.timestamp_millis(F.col("id") * 100).alias("event_time"),
        F.lit(1.0).alias("price"), (F.col("id") % 10).alias("place"), (9 - F.col("id") % 10).alias("left"))
    first, known = state.merged_edges(edges, None, 1000)
    assert first.count() == 200 and known.count() == 400
