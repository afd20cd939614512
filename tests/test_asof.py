"""The as-of merge against a plain search, whatever the skew and the size of a range."""

import bisect
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ticktide.operators import enrich, ordered
from ticktide.operators.asof import asof_merge
from ticktide.plans import views
from tests.test_ordered import most_partitions

LEFT, RIGHT = "id bigint, symbol string, at bigint", "quote bigint, symbol string, at bigint"


def plain(left, right, direction, tolerance, exact):
    result = []
    for row, key, at in left:
        options = sorted((t, quote) for quote, k, t in right if k == key and k is not None and t is not None)
        before = after = None
        if key is not None and at is not None:
            inf = float("inf")
            low = bisect.bisect_right(options, (at, inf)) if exact else bisect.bisect_left(options, (at, -inf))
            high = bisect.bisect_left(options, (at, -inf)) if exact else bisect.bisect_right(options, (at, inf))
            before = options[low - 1] if low else None
            after = options[high] if high < len(options) else None
            before = before if before and (tolerance is None or at - before[0] <= tolerance) else None
            after = after if after and (tolerance is None or after[0] - at <= tolerance) else None
        if direction == "nearest":
            found = before if before and (not after or at - before[0] <= after[0] - at) else after
        else:
            found = before if direction == "backward" else after
        result.append((row, key, at, found[1] if found else None))
    return sorted(map(repr, result))


def tables(spark, left, right):
    return spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(2)


def skewed(rows):
    """Two thirds under one symbol, many at one time, long stretches without quotes, null keys and times."""
    left = [(at, "HOT" if at % 3 else f"S{at % 7}", 500 if at % 4 == 0 else at * 7919 % 1000) for at in range(rows)]
    right = [(at, "HOT" if at % 5 else f"S{at % 9}", 500 if at % 6 == 0 else at * 104729 % 1000 // 100 * 100) for at in range(rows // 4)]
    return left + [(-1, None, 5), (-2, "HOT", None), (-3, "NONE", 5)], right + [(-1, None, 5), (-2, "HOT", None)]


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("rows_per_range, tolerance, exact", [(10, None, True), (10, 30, False), (60, 0, True), (1_000_000, None, False)])
def test_merge_of_skewed_tables(spark, direction, rows_per_range, tolerance, exact):
    left, right = skewed(400)
    found = asof_merge(*tables(spark, left, right), ["symbol"], "at", ties=["quote"], direction=direction, tolerance=tolerance,
                       exact=exact, rows_per_range=rows_per_range)
    assert sorted(repr(tuple(row)) for row in found.collect()) == plain(left, right, direction, tolerance, exact)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("rows_per_range", [1, 9])
def test_many_ranges_in_few_partitions(spark, monkeypatch, direction, rows_per_range):
    """the tasks, each with a result for the driver, do not grow with the ranges."""
    partitions = most_partitions(monkeypatch, ordered)
    left, right = skewed(300)
    found = asof_merge(*tables(spark, left, right), ["symbol"], "at", ties=["quote"], direction=direction,
                       rows_per_range=rows_per_range)
    assert sorted(repr(tuple(row)) for row in found.collect()) == plain(left, right, direction, None, True)
    assert max(partitions) == 4


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("AAB"), st.integers(0, 6)), max_size=25),
       st.lists(st.tuples(st.sampled_from("AAC"), st.integers(0, 6)), max_size=12), st.integers(1, 6),
       st.sampled_from(["backward", "forward", "nearest"]), st.booleans())
def test_merge_property(spark, lefts, rights, rows_per_range, direction, exact):
    left, right = ([(at, *row) for at, row in enumerate(rows)] for rows in (lefts, rights))
    found = asof_merge(*tables(spark, left, right), ["symbol"], "at", ties=["quote"], direction=direction, exact=exact,
                       rows_per_range=rows_per_range)
    assert sorted(repr(tuple(row)) for row in found.collect()) == plain(left, right, direction, None, exact)


def test_inner_merge_and_other_types(spark):
    left = spark.sql("SELECT 1 AS k, DATE'2024-01-03' AS d UNION ALL SELECT 2, DATE'2024-01-03' UNION ALL SELECT 1, DATE'2024-01-09'")
    right = spark.sql("SELECT 1 AS k, DATE'2024-01-01' AS day, map('a', 1) AS held")
    found = asof_merge(left, right, ["k"], "d", "day", tolerance=3, how="inner").collect()
    assert [tuple(row) for row in found] == [(1, left.first().d, {"a": 1})]
    for wrong in (dict(direction="sideways"), dict(how="outer"), dict(columns=["d"])):
        with pytest.raises(ValueError):
            asof_merge(left, right.withColumn("d", F.col("day")), ["k"], "d", "day", **wrong)
    with pytest.raises(TypeError):
        asof_merge(left.withColumn("d", F.lit(1.5)), right, ["k"], "d", "day")


def test_no_window_over_a_whole_key(spark):
    """A key with all rows is cut into ranges of bounded size, and only one row per range crosses them."""
    left = spark.range(5000).select("id", F.lit("HOT").alias("symbol"), (F.col("id") % 50).alias("at"))
    right = spark.range(2000).select(F.col("id").alias("quote"), F.lit("HOT").alias("symbol"), (F.col("id") % 60).alias("at"))
    found = asof_merge(left, right, ["symbol"], "at", ties=["quote"], rows_per_range=500)
    text = found._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if re.search(r"[ +-]Window(Exec)? \[", line)]
    assert any("_segment" in line and "symbol" in line for line in windows)
    assert not any("symbol" in line.split("windowspecdefinition")[1].split("ASC")[0] and "_segment" not in line for line in windows)
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text
    assert found.count() == 5000 and found.where("quote is null").count() == 0


def test_forward_fill_by_ranges_equals_the_window(spark, sf_dir):
    hours = enrich.hours_of(views.ticks(spark, sf_dir))
    observed = enrich.context_series(views.flat_weather(spark, sf_dir), views.sentiment_by_hour(spark, sf_dir))
    whole = enrich.forward_fill_hour(hours, observed, enrich.CONTEXT_COLUMNS)
    cut = enrich.forward_fill_ranges(hours, observed, enrich.CONTEXT_COLUMNS, rows_per_range=30)
    assert sorted(map(repr, cut.select(whole.columns).collect())) == sorted(map(repr, whole.collect()))
