"""Hours that change at once, streams that start at the latest message, and steps on parts of a batch."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticktide.models.learners import LinearLearner, NetworkLearner, train, train_minibatches
from ticktide.schemas import FEATURE_COLUMNS, MESSAGE
from ticktide.session import scratch_path
from ticktide.sinks import hours
from ticktide.streaming import queries as streams

ROWS = "hour string, v int"


def seen(spark, root, as_of=None):
    return {(row.hour, row.v, row.version) for row in hours.read_hours(spark, root, as_of).collect()}


def test_versions_of_hours(spark):
    root = scratch_path(spark, "hours-test")
    assert hours.newest_version(spark, root) == 0
    assert hours.land_hours(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], ROWS), root) == 1
    assert hours.land_hours(spark.createDataFrame([("b", 4)], ROWS), root) == 2
    assert seen(spark, root) == {("a", 1, 1), ("a", 2, 1), ("b", 4, 2)}
    assert seen(spark, root, as_of=1) == {("a", 1, 1), ("a", 2, 1), ("b", 3, 1)} and seen(spark, root, as_of=0) == set()


def test_a_writer_that_dies_leaves_the_old_hour(spark, monkeypatch):
    root = scratch_path(spark, "hours-test")
    hours.land_hours(spark.createDataFrame([("a", 1)], ROWS), root)

    def fail(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(hours, "publish", fail)
        with pytest.raises(RuntimeError):
            hours.land_hours(spark.createDataFrame([("a", 7), ("c", 8)], ROWS), root)
    assert seen(spark, root) == {("a", 1, 1)}
    hours.land_hours(spark.createDataFrame([("a", 9)], ROWS), root)  # takes the number again, and its files
    assert seen(spark, root) == {("a", 9, 2)} and seen(spark, root, 1) == {("a", 1, 1)}


def test_only_the_folders_that_count_are_read(spark):
    root = scratch_path(spark, "hours-test")
    for version in range(4):
        hours.land_hours(spark.createDataFrame([(f"h{at}", version) for at in range(3 if version else 20)], ROWS), root)
    read = hours.read_hours(spark, root)
    folders = {path.split("/data/")[1].rsplit("/", 1)[0] for path in read.inputFiles()}
    assert folders == {f"version={4 if at < 3 else 1}/hour=h{at}" for at in range(20)}
    assert read.count() == 20 and read.agg(F.sum("v")).first()[0] == 9


def test_many_hours_are_packed(spark, monkeypatch):
    """a landing of many hours makes few files, and mixes with landings that have a folder for each hour."""
    monkeypatch.setattr(hours, "FOLDERS", 5, raising=False)
    root = scratch_path(spark, "hours-test")
    assert hours.newest_version(spark, root) == 0
    many = spark.range(400).select(F.concat(F.lit("h"), F.col("id") % 200).alias("hour"), F.col("id").cast("int").alias("v"))
    hours.land_hours(many.union(spark.createDataFrame([(None, -5)], ROWS)), root)
    assert len(hours.read_hours(spark, root).inputFiles()) < 20 and seen(spark, root, 0) == set()
    first = {(f"h{at % 200}", at, 1) for at in range(400)} | {(None, -5, 1)}
    assert seen(spark, root) == first
    hours.land_hours(spark.createDataFrame([("h7", -1), (None, -6)], ROWS), root)
    hours.land_hours(spark.createDataFrame([(f"h{at}", -2) for at in range(100, 110)], ROWS), root)
    hours.land_hours(spark.createDataFrame([(f"h{at}", -3, 0.5) for at in range(100, 102)], ROWS + ", more double"), root)
    gone = {None, "h7", *[f"h{at}" for at in range(100, 110)]}
    kept = {row for row in first if row[0] not in gone}
    now = {("h7", -1, 2), (None, -6, 2)} | {(f"h{at}", -3 if at < 102 else -2, 4 if at < 102 else 3) for at in range(100, 110)}
    assert seen(spark, root) == kept | now and seen(spark, root, as_of=1) == first
    assert hours.read_hours(spark, root).agg(F.sum("more")).first()[0] == 1.0


def test_latest_skips_once(spark):
    root = scratch_path(spark, "latest-test")

    def add(*values):
        rows = spark.createDataFrame([(None, str(value).encode()) for value in values], MESSAGE)
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        messages = spark.readStream.schema(MESSAGE).parquet(f"{root}/in")
        skipped = streams.skip_to_latest(messages, f"{root}/checkpoint")
        streams.start(streams.batches(messages, f"{root}/out", f"{root}/checkpoint"), drain=True)
        return skipped

    add(1, 2)
    assert run()
    add(3)
    assert not run()
    add(4)
    assert not run()
    assert {int(row.value) for row in spark.read.parquet(f"{root}/out").collect()} == {3, 4}


def features(spark, rows):
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(rows, len(FEATURE_COLUMNS))) * 3 + 1
    y = x @ np.arange(len(FEATURE_COLUMNS)) + 2
    data = [(at, *map(float, line), float(target)) for at, (line, target) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "event_id bigint, " + ", ".join(f"{name} double" for name in [*FEATURE_COLUMNS, "y"]))


@pytest.mark.parametrize("learner", [LinearLearner(), NetworkLearner()])
def test_many_steps_in_a_batch(spark, learner):
    rows = features(spark, 600).repartition(3).persist()
    whole, _ = train(rows, learner, learner.start())
    one, _ = train_minibatches(rows, learner, learner.start(), rows_per_step=10_000)
    assert np.allclose(whole.weights, one.weights) and one.step == 1
    first, error = train_minibatches(rows, learner, learner.start(), rows_per_step=50)
    again, _ = train_minibatches(rows.repartition(5), learner, learner.start(), rows_per_step=50)
    assert first.step == 12 and first.seen == 600 and np.allclose(first.weights, again.weights)
    better, later = train_minibatches(rows, learner, first, rows_per_step=50)
    assert better.step == 24 and later.squared_error < error.squared_error
    assert train_minibatches(rows.limit(0), learner, learner.start())[1] is None
