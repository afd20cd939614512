"""Keyed tables, drifting schemas, thinned series and joint panels."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticktide.operators import series, weather
from ticktide.session import scratch_path
from ticktide.sinks.keyed import KeyedTable
from ticktide.sources import drift


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def keyed(spark):
    def make(name="t", keys=("k",), **options):
        root = scratch_path(spark, "keyed-test")
        made.append(f"db_{root[-32:]}")
        return KeyedTable(spark, made[-1], name, list(keys), root, **{"buckets": 4, **options})

    made = []
    yield make
    for database in made:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_keyed_table_against_a_dictionary(spark, keyed):
    rng = random.Random(4)
    table, truth = keyed(max_runs=5), {}
    with pytest.raises(LookupError):
        table.read()
    table.delete(spark.createDataFrame([(1,)], "k int"), 0)  # nothing to delete yet
    for version in range(1, 15):
        some = rng.sample(range(40), rng.randrange(1, 15))
        if version % 3 == 0:
            table.delete(spark.createDataFrame([(k,) for k in some], "k int"), version)
            truth = {k: v for k, v in truth.items() if k not in some}
        else:
            table.write(spark.createDataFrame([(f"v{version}", k) for k in some], "v string, k int"), version)
            truth.update({k: f"v{version}" for k in some})
        assert table.runs() <= 6
        if version % 4 == 0:
            assert {row.k: row.v for row in table.read().collect()} == truth
    table.compact()
    assert {row.k: row.v for row in table.read().collect()} == truth and table.runs() == 1
    assert spark.table(table._known()).count() == len(truth)


def test_reading_and_joining_keyed_tables_shuffles_nothing(spark, keyed):
    left = keyed("l", keys=("a", "b"))
    rows = spark.range(500).select((F.col("id") % 50).alias("a"), F.floor(F.col("id") / 50).alias("b"), F.rand(1).alias("x"))
    left.write(rows, 1)
    left.write(rows.where("a < 9"), 2)
    right = KeyedTable(spark, left.database, "r", ["a", "b"], left.location, buckets=4)
    right.write(rows.select("a", "b", F.col("x").alias("y")), 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(left.read())
        joined = left.read().join(right.read(), ["a", "b"])
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert joined.where("x = y").count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_compaction_that_dies_changes_nothing(spark, keyed, monkeypatch):
    table = keyed()
    table.write(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), 1)
    open_reader = table.read()

    def fail(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "_mark", fail)
        with pytest.raises(RuntimeError):
            table.compact()
    assert table._known().endswith("_g0") and table.read().count() == 2
    table.compact()
    assert table._known().endswith("_g1") and open_reader.count() == 2  # the generation before stays for readers
    table.compact()
    assert table._known().endswith("_g2") and not spark.catalog.tableExists(f"{table.database}.t_g0")


# --- drifting schemas ---

def test_types_widen_over_folders(spark, tmp_path):
    lines = {"a": ['{"x": 1, "y": 1, "z": null, "o": {"p": 1}, "it\'s": 5}', '{"x": 2.5, "y": 2}', "[1, 2]", "nonsense", "  "],
             "b": ['{"x": 3, "y": "text", "z": true, "o": [1]}', '{"y": 2024, "only": null}']}
    for folder, rows in lines.items():
        (tmp_path / f"part={folder}").mkdir()
        (tmp_path / f"part={folder}" / "f.txt").write_text("\n".join(rows))
    variants = drift.read_variants(spark, str(tmp_path), "part")
    types = drift.field_types(variants, "part")
    report = {row.field: row for row in drift.drift_report(types, "part").collect()}
    assert {f: (r.types, r.widened, r.drifts) for f, r in report.items()} == {
        "x": ("bigint,double", "double", True), "y": ("bigint,string", "string", True), "z": ("boolean", "boolean", False),
        "o": ("array,object", "string", True), "it's": ("bigint", "bigint", True), "only": ("", "string", True)}
    rows = drift.read_widened(variants, drift.drift_report(types, "part"), "part").collect()
    assert {(r.part, r.x, r.y) for r in rows if r.y is not None} == {
        ("a", 1.0, "1"), ("a", 2.5, "2"), ("b", None, "2024"), ("b", 3.0, "text")}
    assert [r["it's"] for r in rows if r["it's"] is not None] == [5] and {r.o for r in rows} == {None, '{"p":1}', "[1]"}
    assert len(rows) == 5  # the array is a row without fields, the line that is no JSON is none


# --- series and panels ---

def extents(points, low, width, columns):
    """Per pixel column the lowest and highest value that a line through the points has in it."""
    found = [[np.inf, -np.inf] for _ in range(columns)]

    def mark(column, value):
        found[column] = [min(found[column][0], value), max(found[column][1], value)]

    for t, v in points:
        mark((t - low) // width, v)
    for (t0, v0), (t1, v1) in zip(points, points[1:]):
        first, last = (t0 - low) // width, (t1 - low) // width
        for edge in range(first + 1, last + 1):  # where the line crosses from one column into the next
            value = v0 + (v1 - v0) * (low + edge * width - t0) / (t1 - t0)
            mark(edge - 1, value)
            mark(edge, value)
    return found


def test_m4_draws_the_same_pixels(spark):
    rng = random.Random(8)
    t, points = 1_700_000_000_000_000, []
    for _ in range(1500):
        t += rng.choice([1, 500, 40_000, 2_000_000])
        points.append((t, round(rng.gauss(0, 3), 1)))
    points += [(points[-1][0] + 9_000_000_000, 1.0), (points[-1][0] + 9_000_000_001, 50.0)]
    frame = spark.createDataFrame([(t, v) for t, v in points], "t long, value double").select(F.timestamp_micros("t").alias("date"), "value")
    odd = spark.createDataFrame([(None, 1.0), (dt.datetime(2023, 11, 15), None), (dt.datetime(2023, 11, 15), float("nan"))], frame.schema)
    for columns in (7, 60):
        thin = series.m4_series(frame.unionByName(odd).repartition(3), columns).select(F.unix_micros("date").alias("t"), "value").collect()
        kept = sorted((row.t, row.value) for row in thin)
        low, high = points[0][0], points[-1][0]
        width = max(1, -(-(high - low + 1) // columns))
        assert len(kept) <= 4 * columns and set(kept) <= set(points)
        assert np.allclose(extents(kept, low, width, columns), extents(points, low, width, columns))
    assert series.m4_series(frame.limit(0), 10).count() == 0


def test_m4_and_panels_use_hash_aggregates(spark):
    frame = spark.range(1000).select(F.timestamp_millis(F.col("id")).alias("date"), F.rand(1).alias("value"))
    text = plan(series.m4_series(frame, 20))
    assert "SortAggregate" not in text and "Sort [" not in text and "Python" not in text


def test_pair_grid(spark):
    rng = random.Random(3)
    rows = [(rng.random(), rng.randrange(5), 7.0, rng.choice([None, 1.0, 2.0])) for _ in range(500)]
    frame = spark.createDataFrame(rows, "a double, b int, c double, d double")
    found = {(r.left, r.right, r.left_bin, r.right_bin): r["count"] for r in weather.pair_grid(frame, ("a", "b", "c", "d"), bins=4).collect()}
    bins = []
    for at in range(4):
        values = [row[at] for row in rows if row[at] is not None]
        low, high = min(values), max(values)
        low, high = (low, high) if low < high else (low - 0.5, high + 0.5)
        bins.append([None if row[at] is None else min(int((row[at] - low) / ((high - low) / 4)) + 1, 4) for row in rows])
    expected = Counter(("abcd"[x], "abcd"[y], p, q) for x in range(4) for y in range(x + 1, 4)
                       for p, q in zip(bins[x], bins[y]) if p is not None and q is not None)
    assert found == dict(expected)
    assert weather.pair_grid(frame.limit(0), ("a", "b")).count() == 0
