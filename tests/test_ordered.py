"""Segmented operators equal plain windows, whatever the skew."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from ticktide.operators import ordered, stats, ticks
from ticktide.operators.enrich import feature_table
from ticktide.plans import views

ORDER = ["event_time", "event_id"]


def plain_lags(df):
    over = Window.partitionBy("symbol").orderBy(*ORDER)
    return df.withColumns({"b1": F.lag("price", 1).over(over), "b2": F.lag("price", 2).over(over)})


def skewed(spark, rows=3000):
    """A third of the rows under one symbol, half of those at the same instant."""
    hot = F.col("id") % 3 == 0
    return spark.range(rows).select(
        F.col("id").alias("event_id"),
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("S"), F.col("id") % 7)).alias("symbol"),
        F.when(hot & (F.col("id") % 2 == 0), F.lit(5_000)).otherwise((F.col("id") * 7919) % 10_000).alias("event_time"),
        F.rand(3).alias("price"),
    )


@pytest.mark.parametrize("rows_per_segment", [1, 3, 50, 400, 10_000])
def test_lags_of_a_hot_symbol(spark, rows_per_segment):
    df = skewed(spark, 400 if rows_per_segment < 10 else 3000).persist()
    got = ordered.lagged(df, ["symbol"], ORDER, "price", {"b1": 1, "b2": 2}, rows_per_segment)
    assert got.columns == plain_lags(df).columns
    assert sorted(got.collect(), key=lambda r: r.event_id) == sorted(plain_lags(df).collect(), key=lambda r: r.event_id)


def test_ties_in_the_whole_order_lose_no_carried_row(spark):
    """Equal order values: which of them is first is open, but sums over a key must see all of them."""
    df = spark.range(300).select(
        F.lit("A").alias("symbol"), F.floor(F.col("id") / 20).alias("event_time"), F.lit(0).alias("event_id"),
        F.lit(1.0).alias("price"),
    ).persist()
    for n in (2, 30):
        got = ordered.lagged(df, ["symbol"], ORDER, "price", {"b1": 1, "b2": 2}, n)
        assert got.agg(F.count(F.lit(1)), F.sum("b1"), F.sum("b2")).first() == (300, 299.0, 298.0)


def test_segments_are_balanced(spark):
    df = skewed(spark).persist()
    sizes = ordered.with_segments(df, ["symbol"], ORDER, 30).groupBy("symbol", "_segment").count().collect()
    assert max(r["count"] for r in sizes) <= 300
    assert len([r for r in sizes if r.symbol == "HOT"]) >= 5


def most_partitions(monkeypatch, module):
    """Partitions of the staged tables, with at most four ranges."""
    seen, staged = [], ordered.stage

    def watched(df):
        seen.append(df.rdd.getNumPartitions() if ordered.SEGMENT in df.columns and ordered.TIE in df.columns else 0)
        return staged(df)

    monkeypatch.setattr(module, "stage", watched)
    monkeypatch.setattr(ordered, "RANGES", 4, raising=False)
    return seen


@pytest.mark.parametrize("rows_per_segment", [1, 7, 60])
def test_lags_of_many_segments_in_few_partitions(spark, monkeypatch, rows_per_segment):
    """the tasks, each with a result for the driver, do not grow with the segments."""
    partitions = most_partitions(monkeypatch, ordered)
    df = skewed(spark, 900).persist()
    got = ordered.lagged(df, ["symbol"], ORDER, "price", {"b1": 1, "b2": 2}, rows_per_segment)
    assert sorted(got.collect(), key=lambda r: r.event_id) == sorted(plain_lags(df).collect(), key=lambda r: r.event_id)
    assert max(partitions) == 4
    cut = ordered.with_segments(df, ["symbol"], ORDER, 900 // rows_per_segment + 1, rows_per_segment)
    assert cut.groupBy(ordered.SEGMENT).count().agg(F.max("count")).first()[0] <= rows_per_segment


def test_deep_lags_and_equal_rows(spark):
    df = skewed(spark, 600).persist()
    over = Window.partitionBy("symbol").orderBy(*ORDER)
    expected = df.withColumns({"b7": F.lag("price", 7).over(over)}).orderBy("event_id").collect()
    assert ordered.lagged(df, ["symbol"], ORDER, "price", {"b7": 7}, 20).orderBy("event_id").collect() == expected
    same = spark.range(500).select(F.lit("x").alias("v"))
    numbers = [r.row_no for r in ordered.numbered(same, ["v"], rows_per_segment=50).collect()]
    assert sorted(numbers) == list(range(500))


@pytest.mark.parametrize("rows_per_segment", [1, 7, 100, 10_000])
def test_numbering(spark, rows_per_segment):
    df = skewed(spark, 500).persist()
    got = ordered.numbered(df, ORDER, rows_per_segment=rows_per_segment).orderBy("row_no").collect()
    expected = [r.event_id for r in df.orderBy(*ORDER).collect()]
    assert [r.row_no for r in got] == list(range(500))
    assert [r.event_id for r in got] == expected


@pytest.mark.parametrize("rows_per_segment", [1, 30])
def test_numbering_of_many_segments_in_few_partitions(spark, monkeypatch, rows_per_segment):
    """F7"""
    partitions = most_partitions(monkeypatch, ordered)
    df = skewed(spark, 500).persist()
    got = ordered.numbered(df, ORDER, rows_per_segment=rows_per_segment).orderBy("row_no").collect()
    assert [(r.row_no, r.event_id) for r in got] == list(enumerate(r.event_id for r in df.orderBy(*ORDER).collect()))
    assert max(partitions) == 4


@pytest.mark.parametrize("rows_per_segment", [1, 7, 100, 10_000])
def test_numbering_within_keys(spark, rows_per_segment):
    """also of a null key."""
    df = skewed(spark, 500).withColumn("symbol", F.when(F.col("symbol") != "S3", F.col("symbol"))).persist()
    got = ordered.numbered_within(df, ["symbol"], ORDER, rows_per_segment=rows_per_segment)
    plain = df.withColumn("row_no", F.row_number().over(Window.partitionBy("symbol").orderBy(*ORDER)).cast("bigint") - 1)
    assert got.columns == plain.columns
    assert sorted(got.collect(), key=lambda r: r.event_id) == sorted(plain.collect(), key=lambda r: r.event_id)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("AAAB"), st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=40),
       st.integers(1, 6))
def test_lags_property(spark, rows, rows_per_segment):
    data = [(at, symbol, time, float(price)) for at, (symbol, time, price) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id bigint, symbol string, event_time int, price double")
    got = ordered.lagged(df, ["symbol"], ORDER, "price", {"b1": 1, "b2": 2}, rows_per_segment)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain_lags(df).collect()))


def test_feature_table_is_the_same_when_cut(spark, sf_dir):
    inputs = views.ticks(spark, sf_dir), views.flat_weather(spark, sf_dir), views.sentiment_by_hour(spark, sf_dir)
    whole = feature_table(*inputs)
    cut = feature_table(*inputs, rows_per_segment=20)
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))


@pytest.mark.parametrize("exact_rows", [1_000_000, 300, 50])
def test_quantiles_are_exact(spark, exact_rows):
    import numpy as np

    values = np.round(np.random.default_rng(1).normal(size=4000), 2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = stats.quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], rows=len(values), exact_rows=exact_rows)
    assert got == pytest.approx(list(np.percentile(values, [0, 25, 50, 90, 100])))


def test_quantiles_of_one_repeated_value(spark):
    df = spark.range(1000).select(F.lit(2.0).alias("v"))
    assert stats.quantiles(df, "v", [0.25, 0.75], rows=1000, exact_rows=10) == [2.0, 2.0]


def test_lag_features_segment_argument(spark):
    df = skewed(spark, 300).persist()
    one, many = (ticks.lag_features(df, rows_per_segment=n).collect() for n in (10_000, 10))
    assert sorted(map(repr, one)) == sorted(map(repr, many))
