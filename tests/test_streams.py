"""Streams equal their batch queries, through restarts, late rows, empty batches and replays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticktide.models.learners import LinearLearner, NetworkLearner
from ticktide.operators import ticks
from ticktide.schemas import MESSAGE, RESULT_COLUMNS
from ticktide.sinks.files import batch_path
from ticktide.sources.messages import read_messages
from ticktide.streaming import queries as streams

T0 = dt.datetime(2024, 1, 1)


class Feed:
    """A folder of message files."""

    def __init__(self, spark, root):
        self.spark, self.path, self.next = spark, str(root / "messages"), 0

    def add(self, *rows):
        """(symbol, minutes, price); None gives an unreadable message."""
        data = []
        for row in rows:
            body = "{bad"
            if row:
                symbol, minutes, price = row
                at = (T0 + dt.timedelta(minutes=minutes)).isoformat()
                body = f'{{"symbol":"{symbol}","price":{price},"timestamp":"{at}"}}'
            data.append((str(self.next).encode(), body.encode()))
            self.next += 1
        self.spark.createDataFrame(data, MESSAGE).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return streams.parsed_stream(read_messages(self.spark, "parquet", path=self.path))


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def drain(writer):
    return streams.start(writer, drain=True)


def test_lags_survive_a_restart(spark, feed, tmp_path):
    out, state, checkpoint = (str(tmp_path / name) for name in ("out", "state", "checkpoint"))
    batches = [
        [("A", 0, 10), ("B", 1, 100), None],
        [("A", 2, 12)],
        [("A", 4, 15), ("A", 6, 11), ("B", 7, 90)],
        [None],
        [("B", 9, 95), ("A", 9, 20), ("C", 9, 1)],
        [("A", 10, 21)],
    ]
    for batch in batches:
        feed.add(*batch)
        drain(streams.lag_stream(feed.stream(), out, state, checkpoint, rows_per_segment=2))
    got = {r.event_id: (r.symbol, r.price_1, r.price_2, r.currency_diff) for r in spark.read.parquet(out).collect()}
    plain = streams.usable(spark.read.parquet(feed.path).transform(lambda m: streams.parsed_stream(m)))
    expected = {r.event_id: (r.symbol, r.price_1, r.price_2, r.currency_diff) for r in ticks.lag_features(plain).collect()}
    assert got == expected and len(got) == 10


def test_a_replayed_batch_changes_nothing(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    carried = streams.CarriedPrices(str(tmp_path / "state"))
    feed.add(("A", 0, 10), ("A", 1, 11), ("A", 2, 13))
    batch = streams.usable(streams.parsed_stream(spark.read.parquet(feed.path)))

    def handle(batch_id):
        known = carried.with_state(batch, batch_id)
        streams.write_batch(carried.features(known), out, batch_id)
        carried.save(known, batch_id)
        return sorted(map(repr, spark.read.parquet(out).collect())), sorted(
            map(repr, spark.read.parquet(carried.path(batch_id)).collect())
        )

    handle(0)
    once = handle(1)
    assert handle(1) == once and len(once[0]) == 6 and len(once[1]) == 2


def test_a_late_row_follows_in_order_of_arrival(spark, feed, tmp_path):
    args = [str(tmp_path / name) for name in ("out", "state", "checkpoint")]
    for rows in ([("A", 10, 1), ("A", 11, 2)], [("A", 5, 50)], [("A", 12, 4)]):
        feed.add(*rows)
        drain(streams.lag_stream(feed.stream(), *args))
    got = {r.price: (r.price_1, r.price_2) for r in spark.read.parquet(args[0]).collect()}
    assert got == {1: (None, None), 2: (1, None), 50: (2, 1), 4: (50, 2)}


def test_append_emits_closed_windows_and_drops_late_rows(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        averages = ticks.tumbling_avg(feed.stream(), "1 minute", watermark="1 minute")
        writer = averages.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        drain(writer.outputMode("append"))

    feed.add(("A", 0, 10), ("A", 0.5, 20), ("A", 5, 7))
    run()
    feed.add(("A", 0.2, 1000), ("A", 9, 8))
    run()
    rows = {(r.window_start, r.avg_price) for r in spark.read.parquet(out).collect()}
    assert rows == {(T0, 15.0), (T0 + dt.timedelta(minutes=5), 7.0)}


def test_update_versions_give_the_running_average(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for rows in ([("A", 0, 10)], [("A", 0.5, 20), ("B", 0, 3)]):
        feed.add(*rows)
        drain(streams.average_versions(feed.stream(), out, checkpoint, "10 minutes"))
    versions = spark.read.parquet(out)
    assert versions.where("symbol = 'A'").count() == 2
    newest = versions.groupBy("symbol").agg(F.max_by("avg_price", "batch_id")).collect()
    assert {tuple(r) for r in newest} == {("A", 15.0), ("B", 3.0)}


def test_console_in_complete_mode(feed, tmp_path):
    feed.add(("A", 0, 10))
    query = drain(streams.averages_to_console(feed.stream(), str(tmp_path / "checkpoint")))
    assert "ConsoleTable" in query.lastProgress["sink"]["description"] and query.exception() is None


def test_archive_by_day_with_unreadable_messages(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for rows in ([("BTCUSDT", 0, 1), None], [("BTCUSDT", 24 * 60, 2)]):
        feed.add(*rows)
        query = drain(streams.archive(feed.stream(), out, checkpoint))
        assert query.name == "ticks"
    rows = spark.read.parquet(out)
    assert {(r.base, r.quote, r.price, str(r.day)) for r in rows.collect()} == {
        ("BTC", "", 1.0, "2024-01-01"), (None, None, None, "None"), ("BTC", "", 2.0, "2024-01-02")
    }
    one_day = rows.where("day = '2024-01-02'")
    assert "PartitionFilters: [isnotnull(day" in one_day._jdf.queryExecution().executedPlan().toString()


def test_landing_takes_what_is_new(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "landed"), str(tmp_path / "checkpoint")
    for rows in ([("A", 0, 1), ("A", 61, 2)], [("A", 62, 3)], []):
        if rows:
            feed.add(*rows)
        drain(streams.land_stream(feed.stream(), "event_time", out, checkpoint))
    landed = spark.read.schema("price double, hour string").json(out).collect()
    assert {(r.hour, r.price) for r in landed} == {("2024-01-01-00", 1.0), ("2024-01-01-01", 2.0), ("2024-01-01-01", 3.0)}


def test_source_options_pass_through(spark, feed):
    feed.add(("A", 0, 1))
    limited = read_messages(spark, "parquet", path=feed.path, maxFilesPerTrigger="1")
    assert limited.isStreaming and limited.columns == ["key", "value"]
    with pytest.raises(Exception, match="(?i)kafka"):
        read_messages(spark, "kafka", kafka__bootstrap__servers="h:1", subscribe="t").writeStream.format("noop").start()


@pytest.mark.parametrize("learner", [LinearLearner(), NetworkLearner()])
def test_test_then_train(spark, feed, tmp_path, learner):
    flat = spark.createDataFrame(
        [(T0, city, code, 5.0, 50, 1.0) for city, code in zip("abcde", ("FR", "GB", "JP", "PL", "US"))],
        "hour timestamp_ntz, city_name string, country string, temperature double, humidity int, wind_speed double",
    )
    moods = spark.createDataFrame([(T0, 0.1)], "hour timestamp_ntz, sentiment double")
    root, checkpoint = str(tmp_path / "online"), str(tmp_path / "checkpoint")
    batches = [[("A", at, 10 + at) for at in range(4)], [("A", 10 + at, 20 - at) for at in range(3)],
               [None], [("A", 20, 30), ("A", 21, 31)]]
    for rows in batches:
        feed.add(*rows)
        drain(streams.prequential_stream(feed.stream(), lambda: (flat, moods), learner, root, checkpoint))
    models = [spark.read.parquet(batch_path(f"{root}/models", at)).first() for at in range(4)]
    assert [m.step for m in models] == [0, 1, 1, 2] and [m.version for m in models] == [0, 1, 2, 3]
    stored = spark.read.parquet(f"{root}/results").collect()
    assert len(stored) == 1
    row = stored[0]
    assert row.batch_id == 3 and (row.currency_diff, row.y) == (-1.0, 12.0)
    errors = [(y - row.y_hat) ** 2 for y in (12.0,)]
    assert row.time_stamp == (T0 + dt.timedelta(minutes=20) - dt.datetime(1970, 1, 1)).total_seconds()
    assert row.mse == round(row.mse_exact) and errors[0] > 0
    assert set(RESULT_COLUMNS) <= set(row.asDict())
