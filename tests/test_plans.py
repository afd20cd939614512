"""What the physical plans must look like."""

import re

from pyspark.sql import functions as F

from ticktide.operators import enrich, scoring, stats, ticks
from ticktide.plans import catalogue, views
from ticktide.session import scratch_path
from ticktide.sinks.files import overwrite_hours
from ticktide.sources.files import read_weather_hour


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sentiment_stays_in_the_jvm(spark, sf_dir):
    text = plan(views.sentiment_by_hour(spark, sf_dir))
    assert "Python" not in text and "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # Words are summed before the shuffle: the only exchanges are of texts and of hours.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2


def test_features_shuffle_ticks_once(spark, sf_dir):
    text = plan(views.features(spark, sf_dir))
    assert "Python" not in text and "SortMergeJoin" not in text and "CartesianProduct" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert text.count("BroadcastHashJoin") == 2
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in text


def test_beyond_the_limit_nothing_is_broadcast(spark, sf_dir, monkeypatch):
    from ticktide.operators import sides

    monkeypatch.setattr(sides.small_side, "__defaults__", (10,))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich.asof_hour_join(
            views.ticks(spark, sf_dir), views.flat_weather(spark, sf_dir), views.sentiment_by_hour(spark, sf_dir)
        )
        assert "SortMergeJoin" in plan(joined)
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_hour_is_read_from_its_own_folder(spark, sf_dir):
    root = scratch_path(spark, "hours")
    rows = spark.createDataFrame([("2024-01-01-00", "Paris"), ("2024-01-01-01", "Paris")], "hour string, name string")
    overwrite_hours(rows, root)
    hour = read_weather_hour(spark, root, "2024-01-01-01")
    assert all("/hour=2024-01-01-01/" in path for path in hour.inputFiles()) and hour.count() == 1
    assert hour.first().hour == "2024-01-01-01"


def test_segments_carry_no_arrays_to_the_rows(spark, sf_dir):
    lags = ticks.lag_features(views.ticks(spark, sf_dir), rows_per_segment=10)
    assert "lambda" not in plan(lags) and "CartesianProduct" not in plan(lags)


def test_newest_versions_need_no_sort(spark):
    from ticktide.operators.sides import latest_by

    versions = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("version"), F.lit("text").alias("t"))
    assert "SortAggregate" not in plan(latest_by(versions, ["k"], F.col("version")))


def test_counting_comments_reads_no_bodies(spark, sf_dir):
    text = plan(catalogue.QUERIES["comment_count_flat"](spark, sf_dir))
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint>" in text


def test_time_filter_reaches_the_scan(spark, sf_dir):
    ranged = views.ticks(spark, sf_dir).where(F.col("event_time") >= catalogue.period()[0]).select("price")
    assert "GreaterThanOrEqual(ts" in plan(ranged)


def test_hash_aggregates_for_first_and_last(spark, sf_dir):
    text = plan(ticks.batch_price_stats(views.ticks(spark, sf_dir)))
    assert "HashAggregate" in text and "SortAggregate" not in text and "Sort [" not in text


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    text = plan(catalogue.QUERIES["newest_posts"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
    assert "rangepartitioning" not in plan(catalogue.QUERIES["drop_top3"](spark, sf_dir))


def test_correlations_come_from_one_aggregate(spark, sf_dir):
    text = plan(catalogue.QUERIES["weather_pair_corr"](spark, sf_dir))
    assert text.count("Exchange SinglePartition") == 1 and text.count("partial_corr") == 10


def test_comment_scores_shuffle_no_words(spark, sf_dir):
    text = plan(scoring.comment_scores(views.nested_posts(spark, sf_dir), views.lexicon(spark)))
    assert "SortMergeJoin" not in text.split("posexplode")[0]


def test_histogram_shuffles_bins_only(spark, sf_dir):
    text = plan(stats.histogram(views.ticks(spark, sf_dir), "price"))
    assert "partial_count" in text and "rangepartitioning" not in text
