"""Hand-written rows for the semantics that are easy to get wrong."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ticktide.functions import texts
from ticktide.functions.sentiment import Rules, rules_of
from ticktide.operators import cells, enrich, posts, results, scoring, series, stats, ticks, weather
from ticktide.operators.sides import latest_by, without_top
from ticktide.schemas import COMMENT, POST, RESULT_COLUMNS, WEATHER
from ticktide.sinks import files as sinks
from ticktide.sources import files as landed

T0 = dt.datetime(2024, 1, 1)


def tick_rows(spark, rows):
    """(symbol, minutes, price) to ticks with ids in the given order."""
    data = [(at, symbol, T0 + dt.timedelta(minutes=minutes), float(price)) for at, (symbol, minutes, price) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id bigint, symbol string, event_time timestamp_ntz, price double")


def messages(spark, *bodies):
    frame = spark.createDataFrame([(body,) for body in bodies], "body string")
    return frame.select(F.lit(None).cast("binary").alias("key"), F.col("body").cast("binary").alias("value"))


def test_pair_split(spark):
    frame = spark.createDataFrame([("BTCUSDT",), ("ETHBTC",), ("USDTTRY",), (None,)], "symbol string")
    rows = [(r.base, r.quote) for r in ticks.split_symbol(frame).collect()]
    assert rows == [("BTC", ""), ("ETHBTC", None), ("", "TRY"), (None, None)]


def test_malformed_tick_stays_as_nulls(spark):
    good = '{"symbol":"A","price":1.5,"timestamp":"2024-01-01T00:00:01.000001"}'
    bad_field = '{"symbol":"A","price":"x","timestamp":"2024-01-01T00:00:01"}'
    rows = ticks.parse_ticks(messages(spark, good, "{bad", bad_field)).collect()
    assert (rows[0].symbol, rows[0].price, rows[0].event_time.microsecond) == ("A", 1.5, 1)
    assert tuple(rows[1]) == (None, None, None)
    assert rows[2].symbol == "A" and rows[2].price is None and rows[2].event_time is not None


def test_lag_features_per_symbol(spark):
    frame = tick_rows(spark, [("A", 0, 10), ("B", 1, 100), ("A", 2, 12), ("B", 3, 90), ("A", 4, 15), ("B", 5, 95)])
    rows = {(r.symbol, r.price): r.currency_diff for r in ticks.lag_features(frame).collect()}
    assert rows == {("A", 10): None, ("A", 12): None, ("A", 15): 2, ("B", 100): None, ("B", 90): None, ("B", 95): -10}


def test_batch_delta_looks_at_the_batch_before(spark):
    frame = tick_rows(spark, [("A", 0, 10), ("A", 5, 11), ("A", 70, 14), ("A", 80, 9), ("A", 300, 20)])
    rows = [(r.price, r.y) for r in ticks.batch_delta(frame).orderBy("event_id").collect()]
    assert rows == [(10, None), (11, None), (14, 3), (9, -2), (20, 11)]


def test_batch_price_stats_breaks_ties_by_id(spark):
    frame = tick_rows(spark, [("A", 0, 10), ("A", 0, 11), ("A", 0, 12)])
    row = ticks.batch_price_stats(frame).first()
    assert (row.n, row.first_price, row.last_price) == (3, 10, 12)


def test_comment_score_is_divided_twice(spark):
    lexicon = spark.createDataFrame([("good", 1.0)], "token string, valence double")
    comments = [("a", "good", 0.0, 3), ("b", "plain", 1.0, -1)]
    frame = spark.createDataFrame(
        [("p", 0, "t", 0.0, 1, 0.5, comments), ("q", 0, "t", 0.0, 1, 0.5, []), ("r", 0, "t", 0.0, 1, 0.5, None),
         ("s", 0, "t", 0.0, 1, 0.5, [("c", "good", 0.0, 0), ("d", "good", 0.0, -4), ("e", "good", 0.0, None)])], POST
    )
    one = round(1 / 16**0.5, 4)
    rows = {r.post_id: r.comments_sentiment for r in scoring.comment_scores(frame, lexicon).collect()}
    assert rows == {"p": pytest.approx(one * 3 / 3 / 2), "q": 0.0, "r": 0.0, "s": 0.0}
    both = {r.post_id: r for r in scoring.scored_posts(frame, lexicon).collect()}
    assert {key: r.comments_sentiment for key, r in both.items()} == rows
    assert {r.post_sentiment for r in both.values()} == {0.0}


def test_comment_count_with_and_without_empty(spark):
    frame = spark.createDataFrame(
        [("p", 0, "t", 0.0, 1, 0.5, [("a", "x", 0.0, 3)]), ("q", 0, "t", 0.0, 1, 0.5, []), ("r", 0, "t", 0.0, 1, 0.5, None)], POST
    )
    assert {tuple(r) for r in posts.comment_count(frame).collect()} == {("p", 1)}
    assert {tuple(r) for r in posts.comment_count(frame, keep_empty=True).collect()} == {("p", 1), ("q", 0), ("r", 0)}


@pytest.mark.parametrize(
    "text, expected_total",
    [
        ("good", 1.9),
        ("very good", 1.9 + 0.293),
        ("hardly good", 1.9 - 0.293),
        ("very plain good", 1.9 + 0.293 * 0.95),
        ("not good", 1.9 * -0.74),
        ("isn't good", 1.9 * -0.74),
        ("not plain plain plain good", 1.9),
        ("GOOD plain", 1.9 + 0.733),
        ("GOOD PLAIN", 1.9),
        ("very bad", -(2.5 + 0.293)),
        ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
        ("good!!", 1.9 + 2 * 0.292),
        ("bad!!!!!!", -(2.5 + 4 * 0.292)),
        ("good??", 1.9 + 2 * 0.18),
        ("good?????", 1.9 + 0.96),
        ('"good"...', 1.9),
        ("plain", 0.0),
        ("", 0.0),
        (None, 0.0),
        (":)", 2.0),
    ],
)
def test_sentiment_rules(spark, text, expected_total):
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5), (":)", 2.0)], "token string, valence double")
    frame = spark.createDataFrame([(1, text)], "id int, text string")
    rules = Rules(("not",), ("very",), ("hardly",), "but")
    score = scoring.lexicon_sentiment(frame, ["id"], "text", lexicon, rules).first().sentiment
    assert score == pytest.approx(expected_total / (expected_total**2 + 15) ** 0.5, abs=1e-4)


def test_scorer_hook(spark):
    from ticktide.functions.sentiment import scorer_udf

    frame = spark.createDataFrame([("abc",), (None,), ("",)], "text string")
    assert [r[0] for r in frame.select(scorer_udf(len)("text")).collect()] == [3.0, 0.0, 0.0]


def test_missing_hour_keeps_the_hour_before(spark):
    flat = spark.createDataFrame(
        [(T0 + dt.timedelta(hours=hour), "Paris", "FR", temp, 50, 1.0) for hour, temp in ((1, 5.0), (3, 7.0))],
        "hour timestamp_ntz, city_name string, country string, temperature double, humidity int, wind_speed double",
    )
    moods = spark.createDataFrame([(T0 + dt.timedelta(hours=2), 0.25)], "hour timestamp_ntz, sentiment double")
    frame = tick_rows(spark, [("A", 60 * hour + 5, hour) for hour in (0, 1, 2, 3, 9)])
    rows = enrich.asof_hour_join(frame, flat, moods).orderBy("event_id").collect()
    assert [r.tem_paris for r in rows] == [None, 5.0, 5.0, 7.0, 7.0]
    assert [r.sentiment for r in rows] == [None, None, 0.25, 0.25, 0.25]
    assert [r.tem_london for r in rows] == [None] * 5


def test_weather_columns_are_by_name(spark):
    rows = [("Paris", "FR", 280.15, 40, 1.0), ("London", "GB", 281.15, 41, 2.0), ("Tokyo", "JP", 282.15, 42, 3.0),
            ("Warsaw", "PL", 283.15, 43, 4.0), ("New York", "US", 284.15, 44, 5.0)]
    nested = spark.createDataFrame(
        [(name, (country,), (temp, hum, 1000, temp), (wind,)) for name, country, temp, hum, wind in rows], WEATHER
    ).withColumn("hour", F.lit(T0).cast("timestamp_ntz"))
    wide = weather.pivot_weather(weather.flatten_weather(nested)).first()
    assert wide.tem_paris == pytest.approx(7.0) and wide.hum_paris == 40 and wide.wind_ny == 5.0
    long = weather.unpivot_weather(weather.pivot_weather(weather.flatten_weather(nested)), cities=["wawa"]).collect()
    assert {(r.measure, r.city): round(r.value, 6) for r in long} == {
        ("tem", "wawa"): 10.0, ("hum", "wawa"): 43.0, ("wind", "wawa"): 4.0
    }


def test_histogram_edges(spark):
    frame = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 10)], "v double")
    bins = [r["count"] for r in stats.histogram(frame, "v", 5).orderBy("bin").collect()]
    assert bins == [2, 1, 0, 0, 1]
    same = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert sum(r["count"] for r in stats.histogram_auto(same, "v").collect()) == 2


def test_mse_rounds_half_to_even(spark):
    frame = spark.createDataFrame([(1, 0.5**0.5, 0.0), (2, 1.5**0.5, 0.0), (3, 2.5**0.5, 0.0)], "hour int, y double, y_hat double")
    exact = frame.withColumn("y", F.col("y")).groupBy("hour").agg(*stats.batch_mse()).orderBy("hour").collect()
    assert [round(r.mse_exact, 9) for r in exact] == [0.5, 1.5, 2.5]
    halves = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "v double").select(F.bround("v", 0)).collect()
    assert [r[0] for r in halves] == [0.0, 2.0, 2.0]


@pytest.mark.parametrize(
    "value", [1704067200.0, 0.5, 0.1, -3.25, 0.0, 12345678.9, 1e-05, 1.5e-07, 123456789012.5, -0.0001234]
)
def test_double_text(spark, value):
    frame = spark.createDataFrame([(value,)], "v double")
    assert frame.select(texts.plain_double(F.col("v"))).first()[0] == str(value)


def test_cells_round_trip(spark):
    comments = [("c1", 'say "hi"\nthere', 5.0, 3)]
    frame = spark.createDataFrame([("p", 0, None, 1704067200.0, 7, 0.9, comments)], POST)
    scored = frame.withColumns({"post_sentiment": F.lit(0.25), "comments_sentiment": F.lit(-0.5)})
    stored = cells.cells_of(scored)
    assert stored.first().cells["post_info:post_title"] == "None"
    post = cells.posts_of(stored).first()
    assert (post.post_key, post.post_time, post.post_score, post.post_sentiment) == ("p", 1704067200.0, 7, 0.25)
    assert tuple(cells.comments_of(stored).first()) == ("c1", 'say "hi"\nthere', 5.0, 3, "p")


def test_day_band_includes_both_ends(spark):
    day = 86_400.0
    frame = spark.createDataFrame([(str(at), at) for at in (0.0, 1.0, day, day + 1, day + 2)], "post_id string, post_time double")
    kept = posts.day_band(frame, F.lit(2 * day + 1))
    assert {r.post_time for r in kept.collect()} == {1.0, day, day + 1}


def test_without_top(spark):
    frame = spark.createDataFrame([(str(v), v % 5) for v in range(10)], "id string, score int")
    kept = without_top(frame, [F.desc("score"), F.col("id")], 3)
    assert {r.id for r in kept.collect()} == {str(v) for v in range(10)} - {"4", "9", "3"}


def test_latest_version_wins(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, None), ("b", 1, None)], "k string, v int, t string")
    assert {(r.k, r.v, r.t) for r in latest_by(frame, ["k"], F.col("v")).collect()} == {("a", 3, "z"), ("b", 1, None)}


def test_crowded_post_is_nested_in_parts_without_loss(spark):
    post = spark.createDataFrame([("p", "t", 0.0, 1, 0.5), ("q", "t", 0.0, 1, 0.5)],
                                 "post_id string, post_title string, post_time double, post_score int, post_upvote double")
    comments = spark.range(500).select(
        F.lit("p").alias("post_id"), F.col("id").cast("string").alias("comm_id"), F.lit("x").alias("comm_body"),
        F.col("id").cast("double").alias("comm_time_utc"), F.lit(1).alias("comm_score"),
    )
    nested = posts.nest_comments(post, comments, per_row=50)
    sizes = {(r.post_id, r.part): len(r.comments) for r in nested.collect()}
    assert sum(sizes.values()) == 500 and len(sizes) == 11 and sizes[("q", 0)] == 0 and max(sizes.values()) < 100
    counts = {r.post_id: r["count"] for r in posts.comment_count(nested, keep_empty=True).collect()}
    assert counts == {"p": 500, "q": 0}
    ids = {r.comm_id for r in posts.explode_comments(nested).collect()}
    assert len(ids) == 500


def test_ndjson_keeps_lines_behind_a_bad_one(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"symbol":"A","price":1.0,"timestamp":"2024-01-01T00:00:00"}\n\n   \n{oops\n'
        '{"symbol":"B","price":"x","timestamp":"2024-01-01"}\n{"symbol":"C","price":2,"timestamp":"2024-01-01 10:00:00"}\n'
    )
    (tmp_path / "empty.json").write_text("")
    lines = landed.read_ticks_ndjson(spark, str(tmp_path))
    assert {(r.symbol, r.price) for r in landed.good_ticks(lines).collect()} == {("A", 1.0), ("C", 2.0)}
    assert landed.good_ticks(lines).select("symbol").count() == 2
    assert {r.line for r in landed.bad_ticks(lines).select("line").collect()} == {
        "{oops", '{"symbol":"B","price":"x","timestamp":"2024-01-01"}'
    }


def test_pretty_printed_posts(spark, tmp_path):
    post = {"post_id": "p", "post_title": "t", "post_time": 1.0, "post_score": 2, "post_upvote": 0.5,
            "comments": [{"comm_id": "c", "comm_body": "b", "comm_time_utc": 2.0, "comm_score": 3}]}
    (tmp_path / "posts_got_2024-01-01-00.json").write_text(json.dumps([post, {**post, "post_id": "q"}], indent=4))
    (tmp_path / "posts_got_2024-01-01-01.json").write_text("{broken")
    read = landed.read_posts(spark, str(tmp_path), multi_line=True)
    assert {(r.post_id, r.part) for r in landed.good_posts(read).collect()} == {("p", 0), ("q", 0)}
    assert landed.bad_records(read).count() == 1


def test_layouts_quarantine_the_same_records(spark, tmp_path):
    good = {"post_id": "p", "post_title": "t", "post_time": 1.0, "post_score": 2, "post_upvote": 0.5, "comments": []}
    records = [good, {**good, "post_id": "q", "post_score": "many"}, {**good, "post_id": "r"}]
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "a" / "x.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "b" / "x.json").write_text("\n".join(map(json.dumps, records)))
    for folder, multi_line in (("a", True), ("b", False)):
        read = landed.read_posts(spark, str(tmp_path / folder), multi_line=multi_line)
        assert {r.post_id for r in landed.good_posts(read).collect()} == {"p", "r"}
        assert {r.post_id for r in landed.bad_records(read).collect()} == {"q"}


def test_results_append_by_name_and_prefix(spark, tmp_path):
    name = "golden_results"
    sinks.create_results_table(spark, name, str(tmp_path / "results"))
    values = {column: float(at) for at, column in enumerate(RESULT_COLUMNS)}
    row = spark.createDataFrame([tuple(reversed(values.values()))], ", ".join(f"{c} double" for c in reversed(RESULT_COLUMNS)))
    sinks.append_results(results.typed_results(row), name)
    stored = spark.table(name)
    assert [f.dataType.simpleString() for f in stored.schema] == ["float"] * 17 + ["double"] * 4
    assert stored.first().asDict() == values
    prefixed = stored.toDF(*[f"{name}.{column}" for column in stored.columns])
    assert results.strip_prefix(prefixed, name).columns == RESULT_COLUMNS


def test_result_period_is_inclusive(spark):
    rows = spark.createDataFrame([(0.0,), (60.0,), (120.0,), (120.5,)], "time_stamp double")
    start, end = F.lit(dt.datetime(1970, 1, 1, 0, 1)), F.lit(dt.datetime(1970, 1, 1, 0, 2))
    assert [r.time_stamp for r in results.in_period(rows, start, end).collect()] == [60.0, 120.0]
    bounds = results.time_bounds(rows).first()
    assert bounds.start_date == dt.datetime(1970, 1, 1) and bounds.end_date.microsecond == 500_000


def test_unreadable_date_text_is_null(spark):
    frame = spark.createDataFrame([("2024-01-01 00:00:00",), ("soon",)], "timestamp string")
    assert [r.date for r in series.with_date(frame).collect()] == [T0, None]


def test_landing_an_hour_again_replaces_only_that_hour(spark, tmp_path):
    root = str(tmp_path / "landed")
    schema = "hour string, v int"
    sinks.overwrite_hours(spark.createDataFrame([("h1", 1), ("h2", 2)], schema), root)
    sinks.overwrite_hours(spark.createDataFrame([("h2", 3)], schema), root)
    rows = spark.read.schema(schema).json(root).collect()
    assert {(r.hour, r.v) for r in rows} == {("h1", 1), ("h2", 3)}


def test_compact(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(100).repartition(20).write.parquet(source)
    sinks.compact(spark, source, target)
    assert spark.read.parquet(target).count() == 100
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 1


def test_schema_profile_reads_nested_fields(spark):
    frame = spark.createDataFrame(
        [("p", 0, "t", 0.0, 1, None, [("a", "x", 0.0, 3), ("b", None, 0.0, 3)]), ("q", 0, None, 0.0, 1, 0.5, None)], POST
    )
    profile = {r.path: (r.type, r.non_null) for r in landed.schema_profile(frame).collect()}
    assert profile["post_id"] == ("string", 2) and profile["post_upvote"] == ("double", 1)
    assert profile["comments[].comm_id"] == ("string", 2) and profile["comments[].comm_body"] == ("string", 1)
    assert len(profile) == len(POST) - 1 + len(COMMENT)


def test_a_post_is_scored_each_time_it_lands(spark):
    lexicon = spark.createDataFrame([("good", 1.9)], "token string, valence double")
    rows = [(hour, "p", 0, "good day", 0.0, 1, 0.5, []) for hour in ("2024-01-02-10", "2024-01-02-11")]
    frame = spark.createDataFrame(rows, "hour string, post_id string, part int, post_title string, post_time double, "
                                  f"post_score int, post_upvote double, comments array<{COMMENT.simpleString()}>")
    once = round(1.9 / (1.9 ** 2 + 15) ** 0.5, 4)
    scores = scoring.post_scores(frame, lexicon, keys=["hour", "post_id"]).collect()
    assert [r.post_sentiment for r in scores] == [once, once]
    moods = scoring.hourly_sentiment(frame, lexicon).orderBy("hour").collect()
    assert [(r.hour, r.sentiment) for r in moods] == [(dt.datetime(2024, 1, 2, hour), once) for hour in (10, 11)]


def test_comments_without_or_with_repeated_ids_count_each(spark):
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "token string, valence double")
    texts = [(None, "good", 0.0, 3), (None, "bad", 1.0, None), ("a", "bad", 2.0, 1), ("a", "good", 2.0, 1)]
    frame = spark.createDataFrame([("p", 0, "good", 0.0, 1, 0.5, texts)], POST)
    good, bad = (round(v / (v * v + 15) ** 0.5, 4) for v in (1.9, -2.5))
    row = scoring.scored_posts(frame, lexicon).first()
    assert row.post_sentiment == good
    assert row.comments_sentiment == pytest.approx((good * 3 + bad + good) / 5 / 4)


def test_parts_of_a_crowded_post_score_and_upsert_together(spark, tmp_path):
    lexicon = spark.createDataFrame([("good", 1.9)], "token string, valence double")
    post = spark.createDataFrame([("p", "good", 0.0, 1, 0.5)],
                                 "post_id string, post_title string, post_time double, post_score int, post_upvote double")
    comments = spark.range(10).select(
        F.lit("p").alias("post_id"), F.col("id").cast("string").alias("comm_id"), F.lit("good").alias("comm_body"),
        F.col("id").cast("double").alias("comm_time_utc"), F.lit(2).alias("comm_score"),
    )
    whole, parts = posts.nest_comments(post, comments), posts.nest_comments(post, comments, per_row=4)
    assert parts.count() > 1
    one, many = (scoring.scored_posts(frame, lexicon).select("post_sentiment", "comments_sentiment").distinct().collect()
                 for frame in (whole, parts))
    assert one == many
    sinks.append_versions(cells.cells_of(scoring.scored_posts(parts, lexicon).withColumn("version", F.lit(1)), "version"), str(tmp_path))
    stored = sinks.read_latest(spark, str(tmp_path), ["post_id", "part"], F.col("version"))
    assert cells.comments_of(stored).count() == 10 and cells.posts_of(stored).count() == 1


def test_ticks_without_ids_have_first_last_and_delta(spark):
    frame = tick_rows(spark, [("A", 0, 10), ("A", 0, 12), ("A", 3600, 13)]).withColumn("event_id", F.lit(None).cast("bigint"))
    stats_rows = ticks.batch_price_stats(frame).orderBy("hour").collect()
    assert {stats_rows[0].first_price, stats_rows[0].last_price} == {10, 12} and stats_rows[1].last_price == 13
    assert [r.y for r in ticks.batch_delta(frame).where("y is not null").collect()] == [13 - stats_rows[0].last_price]


def test_without_top_removes_no_copy_too_many(spark):
    frame = spark.createDataFrame([("a", 5)] * 5 + [("b", 1), (None, 2)], "id string, score int")
    kept = without_top(frame, [F.desc("score")], 3)
    assert sorted(kept.collect(), key=str) == sorted(frame.where("score < 5").collect() + frame.limit(2).collect(), key=str)


def test_rules_come_from_a_table(spark):
    table = spark.createDataFrame([("not", "negator"), ("very", "intensifier"), ("but", "contrast")], "token string, kind string")
    assert rules_of(table) == Rules(("not",), ("very",), (), "but")
    assert rules_of(table.limit(0)) == Rules()


def test_a_title_is_scored_once_for_all_its_landings(spark):
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")
    rows = [("p", 0, "good", "2024-01-01-01"), ("p", 0, "good", "2024-01-01-02"), ("p", 0, "bad", "2024-01-01-02"),
            ("q", 0, None, "2024-01-01-02"), ("q", 1, "good", "2024-01-01-02")]
    landed = spark.createDataFrame(rows, "post_id string, part int, post_title string, hour string")
    moods = {row.hour.hour: row.sentiment for row in scoring.hourly_sentiment(landed, lexicon).collect()}
    assert moods[1] > 0.3 and moods[2] == 0.0
    posts_once = landed.where("hour = '2024-01-01-01'").withColumn("post_time", F.lit(0.0))
    dealt = scoring.landing_sentiment(posts_once, lexicon).collect()
    assert len(dealt) == 25 and {row.sentiment for row in dealt} == {moods[1]}
