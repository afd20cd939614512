"""All registered queries: (session, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ticktide.functions.times import hour_key
from ticktide.models.learners import LinearLearner, NetworkLearner, train, train_minibatches
from ticktide.models.state import latest_models, load, to_frame
from ticktide.operators import cells, enrich, ordered, phrases as phrased, posts, results, scoring, series, stats, ticks, weather
from ticktide.operators.asof import asof_merge
from ticktide.operators.sides import latest_by, without_top
from ticktide.plans import views
from ticktide.schemas import FEATURE_COLUMNS, POST_KEY, WEATHER_COLUMNS
from ticktide.session import prepare, scratch_path, stage
from ticktide.sinks import files as sinks, hours
from ticktide.sinks.keyed import KeyedTable
from ticktide.sources import drift, files as landed
from ticktide.sources.messages import read_messages
from ticktide.sources.tables import read_results, run_query
from ticktide.streaming import queries as streams, state

Query = Callable[[SparkSession, str], DataFrame]
SLICES = 3
PERIOD = ("2024-01-08 00:00:00", "2024-01-22 12:00:00")


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def period() -> tuple[Column, Column]:
    return tuple(F.lit(text).cast("timestamp_ntz") for text in PERIOD)


# -- ticks ---------------------------------------------------------------------------------------------

def parse_ticks(spark, sf_dir):
    parsed = ticks.parse_ticks(views.tick_messages(spark, sf_dir).drop("event_time"))
    return parsed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def split_symbol(spark, sf_dir):
    return ticks.split_symbol(views.ticks(spark, sf_dir)).select("event_id", "symbol", "base", "quote")


def hour_keys(spark, sf_dir):
    return views.ticks(spark, sf_dir).select("event_id", hour_key(F.col("event_time")).alias("hour_key"))


def tumbling_avg(spark, sf_dir):
    return rounded(ticks.tumbling_avg(views.ticks(spark, sf_dir)), "avg_price")


def lag_features(spark, sf_dir):
    lags = ticks.lag_features(views.ticks(spark, sf_dir))
    return rounded(lags.select("event_id", "symbol", "price", "price_1", "price_2", "currency_diff"), "currency_diff")


def batch_delta(spark, sf_dir):
    delta = ticks.batch_delta(views.ticks(spark, sf_dir))
    return rounded(delta.select("event_id", "symbol", "hour", "price", "previous_price", "y"), "y")


def batch_price_stats(spark, sf_dir):
    return ticks.batch_price_stats(views.ticks(spark, sf_dir))


def _without_ids(spark, sf_dir):
    """Ticks as real messages bring them, without an id; the number only names the rows of the result."""
    return views.ticks(spark, sf_dir).select(
        F.col("event_id").alias("row"), F.lit(None).cast("bigint").alias("event_id"), "symbol", "price", "event_time")


def lag_features_no_id(spark, sf_dir):
    lags = ticks.lag_features(_without_ids(spark, sf_dir))
    return rounded(lags.select("row", "price_1", "price_2", "currency_diff"), "currency_diff")


def batch_delta_no_id(spark, sf_dir):
    delta = ticks.batch_delta(_without_ids(spark, sf_dir))
    return rounded(delta.select("row", "previous_price", "y"), "y")


def batch_price_stats_no_id(spark, sf_dir):
    return ticks.batch_price_stats(_without_ids(spark, sf_dir))


def lag_features_cut(spark, sf_dir):
    """Lags with a limit that every symbol exceeds, so that all rows go through segments; three rows back."""
    lags = ordered.lagged(views.ticks(spark, sf_dir), ["symbol"], ticks.TICK_ORDER, "price",
                          {"price_1": 1, "price_2": 2, "price_3": 3}, rows_per_segment=100)
    return lags.select("event_id", "price_1", "price_2", "price_3")


def ticks_numbered_cut(spark, sf_dir):
    """Row numbers over segments; the prices, rounded, tie often."""
    rows = views.ticks(spark, sf_dir).select(F.round("price").alias("price"), "event_id")
    return ordered.numbered(rows, ["price"], rows_per_segment=300)


def histogram_auto_narrowed(spark, sf_dir):
    """As ``histogram_auto``, with quantiles found by narrowing instead of by ordering all values."""
    found = stats.histogram_auto(views.ticks(spark, sf_dir), "price", exact_rows=500)
    return rounded(found, "bin_start", "bin_end")


def filter_time_range(spark, sf_dir):
    text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    dated = series.with_date(views.ticks(spark, sf_dir).select("symbol", "price", text.alias("timestamp")))
    return series.in_time_range(dated, *period()).select("symbol", "price", "date")


def series_price(spark, sf_dir):
    return series.price_series(views.ticks(spark, sf_dir), at="event_time")


def series_price_hourly(spark, sf_dir):
    return rounded(series.price_series(views.ticks(spark, sf_dir), "1 hour", at="event_time"), "value")


def series_price_m4(spark, sf_dir):
    """Prices per symbol thinned to what a plot of 200 pixel columns shows."""
    return series.m4_series(views.ticks(spark, sf_dir), 200, "event_time", "price", ["symbol"])


def ndjson_lines(spark, sf_dir):
    root = scratch_path(spark, "tick-lines")
    views.tick_lines(spark, sf_dir).write.text(root)
    return landed.read_ticks_ndjson(spark, root)


def ndjson_scan_good(spark, sf_dir):
    good = series.with_date(landed.good_ticks(ndjson_lines(spark, sf_dir)))
    return good.select("symbol", "price", "date")


def ndjson_scan_bad(spark, sf_dir):
    return landed.bad_ticks(ndjson_lines(spark, sf_dir))


# -- posts ---------------------------------------------------------------------------------------------

def _landed_posts(spark, sf_dir):
    root = scratch_path(spark, "posts")
    views.land_posts(views.nested_posts(spark, sf_dir), root)
    return landed.read_hourly_posts(spark, root)


def _shown(comments: str | Column = "comments") -> Column:
    """Whole comments as one text."""
    return F.array_join(F.transform(comments, lambda c: F.concat_ws(
        ":", c["comm_id"], c["comm_time_utc"].cast("bigint"), c["comm_score"], c["comm_body"])), ",").alias("comments")


def posts_scan(spark, sf_dir):
    good = landed.good_posts(_landed_posts(spark, sf_dir))
    return good.select("hour", "post_id", "part", "post_title", "post_time", "post_score", "post_upvote", _shown())


def posts_scan_multiline(spark, sf_dir):
    """The same posts as indented arrays, about one file a day."""
    root = scratch_path(prepare(spark), "posts")
    views.land_indented_posts(views.nested_posts(spark, sf_dir), root)
    good = landed.good_posts(landed.read_hourly_posts(spark, root, landed.read_documents))
    return good.select("hour", "post_id", "part", "post_title", "post_time", "post_score", "post_upvote", _shown())


def posts_scan_split(spark, sf_dir):
    """The same arrays cut into records over byte ranges, so that no file is one string in one task."""
    root = scratch_path(prepare(spark), "posts")
    views.land_indented_posts(views.nested_posts(spark, sf_dir), root)
    good = landed.good_posts(landed.read_hourly_posts(spark, root, landed.read_split_documents))
    return good.select("hour", "post_id", "part", "post_title", "post_time", "post_score", "post_upvote", _shown())


def _comment_rows(parts):
    return parts.select("post_id", F.inline("comments")).select(
        "post_id", "comm_id", "comm_body", "comm_time_utc", "comm_score")


def posts_scan_parts(spark, sf_dir):
    """All comments in the order of their post, joined with their posts, from landed posts of which every one with more than
    one comment is crowded. Also comments whose post is missing or not named; a post that was pulled twice brings its
    comments once and counts twice."""
    root = scratch_path(prepare(spark), "posts")
    views.land_posts(posts.nest_all(views.posts_flat(spark, sf_dir), views.comments_flat(spark, sf_dir), per_row=1), root)
    placed = posts.placed_comments(landed.good_posts(landed.read_hourly_posts(spark, root), keyless=True))
    return placed.select("post_id", "comm_id", "comm_body", "comm_time_utc", "comm_score", "place", "posts")


def comments_to_json_parts(spark, sf_dir):
    rows = posts.comments_to_json(views.nested_posts(spark, sf_dir, per_row=1))
    kind = landed.POST["comments"].dataType.simpleString()
    return _comment_rows(rows.select("post_id", F.from_json("comments_json", kind).alias("comments")))


def posts_nest_from_flat(spark, sf_dir):
    nested = views.nested_posts(spark, sf_dir)
    return nested.select("post_id", "part", "post_title", "post_time", "post_score", "post_upvote", _shown())


def posts_day_band(spark, sf_dir):
    flat = views.posts_flat(spark, sf_dir)
    as_of = flat.agg(F.max("post_time") + posts.DAY).scalar()
    return posts.day_band(flat, as_of)


def newest_posts(spark, sf_dir):
    return posts.newest(views.posts_flat(spark, sf_dir)).select("post_id", "post_title", "post_time")


def comment_count(spark, sf_dir):
    """Counted in landed posts, of which only the lengths of the arrays are needed."""
    return posts.comment_count(landed.good_posts(_landed_posts(spark, sf_dir)))


def comment_count_flat(spark, sf_dir):
    return posts.count_flat(views.comments_flat(spark, sf_dir))


def comment_count_outer(spark, sf_dir):
    return posts.comment_count(landed.good_posts(_landed_posts(spark, sf_dir)), keep_empty=True)


def comments_to_json(spark, sf_dir):
    return posts.comments_to_json(views.nested_posts(spark, sf_dir))


def posts_join_comments(spark, sf_dir):
    joined = posts.join_comments(views.posts_flat(spark, sf_dir), views.comments_flat(spark, sf_dir))
    return joined.select("post_id", "post_title", "post_score", "comm_id", "comm_body", "comm_score")


def drop_top3(spark, sf_dir):
    comments = views.comments_flat(spark, sf_dir)
    order = [F.desc("comm_score"), F.col("comm_id")]
    return without_top(comments.select("comm_id", "comm_score"), order, 3)


def histogram_comment_count(spark, sf_dir):
    counts = stage(comment_count(spark, sf_dir))
    return rounded(stats.histogram(counts, "count"), "bin_start", "bin_end")


def histogram_comm_score(spark, sf_dir):
    return rounded(stats.histogram(stage(drop_top3(spark, sf_dir)), "comm_score"), "bin_start", "bin_end")


def histogram_auto(spark, sf_dir):
    return rounded(stats.histogram_auto(views.ticks(spark, sf_dir), "price"), "bin_start", "bin_end")


def file_audit(spark, sf_dir):
    """Rows of every landed file, with the file's audit attributes summed up per hour."""
    audit = landed.file_audit(_landed_posts(spark, sf_dir), "hour")
    return audit.groupBy("hour").agg(
        F.sum("rows").alias("rows"),
        F.bool_and(F.col("file_size") > 0).alias("has_bytes"),
        F.bool_and(F.col("modified").isNotNull()).alias("has_time"),
    )


def hour_partition_overwrite(spark, sf_dir):
    """Land all hours, then land the newest hour again with changed scores: only that hour changes."""
    root = scratch_path(spark, "hours")
    nested = views.nested_posts(spark, sf_dir)
    views.land_posts(nested, root)
    newest = views.posts_flat(spark, sf_dir).agg(F.max("post_time")).scalar()
    again = nested.where(F.col("post_time") == newest)
    views.land_posts(again.withColumn("post_score", F.col("post_score") + 1000), root)
    good = landed.good_posts(landed.read_hourly_posts(spark, root))
    return good.select("hour", "post_id", "post_score")


def hour_as_of_version(spark, sf_dir):
    """All hours landed, the newest one replaced, and a landing that never finished: as of both versions."""
    root = scratch_path(prepare(spark), "versioned")
    rows = views.posts_flat(spark, sf_dir).select(
        F.date_format(F.timestamp_seconds("post_time"), "yyyy-MM-dd-HH").alias("hour"), "post_id", "post_score")
    first = hours.land_hours(rows, root)
    newest = rows.where(F.col("hour") == rows.agg(F.max("hour")).scalar()).withColumn("post_score", F.col("post_score") + 1000)
    second = hours.land_hours(newest, root)
    hours.write_version(rows.withColumn("post_score", F.lit(-1)), root, second + 1)
    seen = [hours.read_hours(spark, root, at).withColumn("as_of", F.lit(name))
            for at, name in ((first, "first"), (None, "now"))]
    return seen[0].unionByName(seen[1]).select("as_of", "hour", "post_id", "post_score", "version")


def schema_profile(spark, sf_dir):
    root = scratch_path(spark, "weather")
    views.land_weather(spark, sf_dir, root)
    return landed.schema_profile(landed.read_inferred(spark, root))


# -- sentiment -----------------------------------------------------------------------------------------

def lexicon_sentiment(spark, sf_dir):
    texts = views.table(prepare(spark), sf_dir, "conversations")
    return scoring.lexicon_sentiment(texts, ["conv_id", "turn"], "text", views.lexicon(spark), views.rules(spark))


def phrase_sentiment(spark, sf_dir):
    texts = views.table(prepare(spark), sf_dir, "conversations")
    return phrased.phrase_sentiment(
        texts, ["conv_id", "turn"], "text", views.lexicon(spark), views.phrases(spark), views.rules(spark))


def post_scores(spark, sf_dir):
    return scoring.post_scores(views.nested_posts(spark, sf_dir), views.lexicon(spark), views.rules(spark))


def comment_scores_parts(spark, sf_dir):
    """Scores of crowded posts whose comments have no id, or share one."""
    anonymous = F.transform("comments", lambda c, at: c.withField("comm_id", F.when(at % 2 == 0, F.lit("same"))))
    nested = views.nested_posts(spark, sf_dir, per_row=1).withColumn("comments", anonymous)
    return rounded(scoring.comment_scores(nested, views.lexicon(spark), views.rules(spark)), "comments_sentiment")


def comment_scores(spark, sf_dir):
    scores = scoring.comment_scores(views.nested_posts(spark, sf_dir), views.lexicon(spark), views.rules(spark))
    return rounded(scores, "comments_sentiment")


def hourly_sentiment(spark, sf_dir):
    """From landed files: a post is written once and counts in the 25 hours whose pulls bring it."""
    root = scratch_path(prepare(spark), "posts")
    views.land_posts(views.nested_posts(spark, sf_dir).drop("comments"), root)
    good = landed.good_posts(landed.read_hourly_posts(spark, root))
    return rounded(scoring.landing_sentiment(good, views.lexicon(spark), views.rules(spark)), "sentiment")


# -- keyed cells ---------------------------------------------------------------------------------------

def _cells(spark, sf_dir, per_row=posts.COMMENTS_PER_ROW):
    """A stored keyed table of scored posts, written twice: the newer version of every key counts."""
    root = scratch_path(prepare(spark), "keyed")
    scored = scoring.scored_posts(views.nested_posts(spark, sf_dir, per_row), views.lexicon(spark), views.rules(spark))
    scored = rounded(scored, "comments_sentiment").persist()
    for version, score in ((1, F.col("post_score") + 1000), (2, F.col("post_score"))):
        rows = scored.withColumns({"post_score": score, "version": F.lit(version)})
        sinks.append_versions(cells.cells_of(rows, "version"), root)
    scored.unpersist()
    return sinks.read_latest(spark, root, POST_KEY, F.col("version"))


def kv_row_cells(spark, sf_dir):
    """All seven cells of every row of the stored table."""
    return _cells(spark, sf_dir).select("post_id", F.explode("cells").alias("qualifier", "value"))


def kv_scan_posts(spark, sf_dir):
    return cells.posts_of(_cells(spark, sf_dir))


def kv_scan_comments(spark, sf_dir):
    return cells.comments_of(_cells(spark, sf_dir))


def kv_upsert_parts(spark, sf_dir):
    """Comments of crowded posts after the upsert."""
    return cells.comments_of(_cells(spark, sf_dir, per_row=1))


def kv_upsert_latest(spark, sf_dir):
    """Two writes of the same keys; the second changes the score of every other post."""
    root = scratch_path(spark, "keyed")
    first = views.posts_flat(spark, sf_dir).withColumn("version", F.lit(1).cast("bigint"))
    second = first.where(F.col("post_id").cast("bigint") % 2 == 0).withColumns({
        "post_score": F.col("post_score") + 1000, "version": F.lit(2).cast("bigint"),
    })
    sinks.append_versions(first, root)
    sinks.append_versions(second, root)
    latest = sinks.read_latest(spark, root, ["post_id"], F.col("version"))
    return latest.select("post_id", "post_score", "version")


def kv_compacted_scan(spark, sf_dir):
    """Posts written, partly replaced, partly deleted, folded into the next generation, and partly written again."""
    root = scratch_path(prepare(spark), "kept")
    table = KeyedTable(spark, f"kept_{root[-32:]}", "posts", ["post_id"], root, buckets=8)
    rows = views.posts_flat(spark, sf_dir).select("post_id", "post_title", "post_score")
    number = F.col("post_id").cast("bigint")
    table.write(rows.withColumn("post_score", F.col("post_score") + 1000), 1)
    table.write(rows.where(number % 2 == 0), 2)
    table.delete(rows.where(number % 7 == 0), 3)
    table.compact()
    table.write(rows.where(number % 14 == 0).withColumn("post_score", -F.col("post_score")), 4)
    table.delete(rows.where(number % 5 == 1), 5)
    return table.versions()


# -- weather -------------------------------------------------------------------------------------------

def _landed_weather(spark, sf_dir):
    root = scratch_path(spark, "weather")
    views.land_weather(spark, sf_dir, root)
    return root


def weather_scan_hour(spark, sf_dir):
    """The newest landed hour, as the hourly job reads it."""
    root = _landed_weather(spark, sf_dir)
    newest = views.ticks(spark, sf_dir).agg(hour_key(F.max("event_time"))).first()[0]
    hour = weather.flatten_weather(landed.read_weather_hour(spark, root, newest))
    return rounded(hour, "temperature", "wind_speed")


def weather_flatten(spark, sf_dir):
    return rounded(views.flat_weather(spark, sf_dir), "temperature", "wind_speed")


def weather_union_files(spark, sf_dir):
    files = landed.read_weather(spark, _landed_weather(spark, sf_dir))
    return rounded(weather.raw_measures(files), "wind_speed", "temp", "feels_like")


def weather_pivot(spark, sf_dir):
    return rounded(weather.pivot_weather(views.flat_weather(spark, sf_dir)), *WEATHER_COLUMNS)


def weather_unpivot(spark, sf_dir):
    return weather.unpivot_weather(weather_pivot(spark, sf_dir), cities=["paris", "ny"])


def weather_pair_corr(spark, sf_dir):
    return rounded(weather.pair_correlation(weather.raw_measures(views.nested_weather(spark, sf_dir))), "corr")


def weather_pair_grid(spark, sf_dir):
    """The joint panels of the pair plot."""
    return weather.pair_grid(weather.raw_measures(views.nested_weather(spark, sf_dir)))


def _drifting(spark, sf_dir, land, partition):
    root = scratch_path(prepare(spark), "drift")
    land(spark, sf_dir, root)
    variants = drift.read_variants(spark, root, partition)
    return variants, drift.drift_report(drift.field_types(variants, partition), partition)


def posts_schema_drift(spark, sf_dir):
    """Fields and types of landed posts whose producers differ."""
    return _drifting(spark, sf_dir, views.land_drifting_posts, "producer")[1]


def weather_union_drift(spark, sf_dir):
    """Weather files whose fields and types differ, as one table."""
    variants, report = _drifting(spark, sf_dir, views.land_drifting_weather, "old")
    return drift.read_widened(variants, report)


def weather_histograms(spark, sf_dir):
    """The diagonal of the pair plot: one automatic histogram per measure."""
    measures = stage(weather.raw_measures(views.nested_weather(spark, sf_dir)))
    parts = [
        stats.histogram_auto(measures, name).withColumn("measure", F.lit(name)) for name in weather.PAIR_MEASURES
    ]
    return rounded(weather.union_weather(parts), "bin_start", "bin_end")


# -- enrichment ----------------------------------------------------------------------------------------

def forward_fill_hour(spark, sf_dir):
    hours = enrich.hours_of(views.ticks(spark, sf_dir))
    observed = enrich.context_series(views.flat_weather(spark, sf_dir), views.sentiment_by_hour(spark, sf_dir))
    return rounded(enrich.forward_fill_hour(hours, observed, enrich.CONTEXT_COLUMNS), "value")


def asof_hour_join(spark, sf_dir):
    joined = enrich.asof_hour_join(
        views.ticks(spark, sf_dir), views.flat_weather(spark, sf_dir), views.sentiment_by_hour(spark, sf_dir)
    )
    return rounded(joined.select("event_id", "hour", *enrich.CONTEXT_COLUMNS), *enrich.CONTEXT_COLUMNS)


def feature_table(spark, sf_dir):
    return rounded(views.features(spark, sf_dir), *FEATURE_COLUMNS, "y")


def feature_vector(spark, sf_dir):
    """The vector per tick, shown by its length and its dot product with 1..17."""
    vectors = enrich.feature_vector(enrich.complete(views.features(spark, sf_dir)))
    positions = F.array(*[F.lit(float(at)) for at in range(1, len(FEATURE_COLUMNS) + 1)])
    products = F.zip_with("x", positions, lambda value, at: value * at)
    return rounded(
        vectors.select(
            "event_id",
            F.size("x").cast("bigint").alias("width"),
            F.aggregate(products, F.lit(0.0), lambda total, value: total + value).alias("dot"),
        ),
        "dot",
    )


# -- merges on time ------------------------------------------------------------------------------------

def forward_fill_ranges(spark, sf_dir):
    """The fill over ranges of 500 points, whatever the length of a series."""
    hours = enrich.hours_of(views.ticks(spark, sf_dir))
    observed = enrich.context_series(views.flat_weather(spark, sf_dir), views.sentiment_by_hour(spark, sf_dir))
    filled = enrich.forward_fill_ranges(hours, observed, enrich.CONTEXT_COLUMNS, rows_per_range=500)
    return rounded(filled, "value").select("hour", "series", "value")


def _quoted(spark, sf_dir, *columns, **options):
    found = asof_merge(views.trades(spark, sf_dir), views.quotes(spark, sf_dir), ["symbol"], "event_time", "quoted_at",
                       ties=["quote_id"], **options)
    return found.select("event_id", "symbol", "price", *columns)


def asof_ticks_quotes(spark, sf_dir):
    """Each trade with the last quote of its symbol."""
    return _quoted(spark, sf_dir, "quote_id", "bid")


def asof_ticks_quotes_cut(spark, sf_dir):
    """The same over ranges so small that every symbol, and many a minute, is cut."""
    return _quoted(spark, sf_dir, "quote_id", "bid", rows_per_range=200)


def asof_next_quote(spark, sf_dir):
    """Each trade with the first quote after it, at most ten minutes away."""
    return _quoted(spark, sf_dir, "quote_id", "bid", direction="forward", exact=False, tolerance=600_000_000)


def asof_nearest_quote(spark, sf_dir):
    """Each trade with the nearest quote, at most two minutes away."""
    return _quoted(spark, sf_dir, "quote_id", direction="nearest", tolerance=120_000_000)


# -- results -------------------------------------------------------------------------------------------

def _results(spark, sf_dir):
    return results.batch_results(rounded(views.predicted(spark, sf_dir), *FEATURE_COLUMNS, "y", "y_hat"))


def _results_table(spark, sf_dir):
    location = scratch_path(spark, "results")
    name = f"results_{location[-32:]}"
    sinks.create_results_table(spark, name, location)
    sinks.append_results(_results(spark, sf_dir), name)
    return name


def _forget(spark, name, opened):
    """Take a table out of the catalog again. Its files stay at their own location, where ``opened`` reads."""
    spark.sql(f"DROP TABLE {name}")
    return opened


def results_append(spark, sf_dir):
    name = _results_table(spark, sf_dir)
    return _forget(spark, name, read_results(spark, name))


def results_scan(spark, sf_dir):
    name = _results_table(spark, sf_dir)
    found = run_query(spark, f"SELECT * FROM {name}")
    prefixed = found.toDF(*[f"{name}.{column}" for column in found.columns])
    return _forget(spark, name, results.strip_prefix(prefixed, name))


def results_time_range(spark, sf_dir):
    within = results.in_period(results.dated(_results(spark, sf_dir)), *period())
    return ordered.numbered(within.select("date", "time_stamp", "y", "y_hat", "mse"), ["time_stamp"])


def results_time_bounds(spark, sf_dir):
    return results.time_bounds(_results(spark, sf_dir))


def batch_mse(spark, sf_dir):
    predicted = rounded(views.predicted(spark, sf_dir), *FEATURE_COLUMNS, "y", "y_hat")
    return rounded(predicted.groupBy("hour").agg(*stats.batch_mse()), "mse_exact")


def series_prediction(spark, sf_dir):
    return series.prediction_series(results.dated(_results(spark, sf_dir)))


def series_mse(spark, sf_dir):
    return series.mse_series(results.dated(_results(spark, sf_dir)))


def series_sentiment(spark, sf_dir):
    return series.sentiment_series(results.dated(_results(spark, sf_dir)))


def series_weather(spark, sf_dir):
    return series.weather_series(results.dated(_results(spark, sf_dir)), ["paris", "ny"])


# -- models --------------------------------------------------------------------------------------------

def _model_rows(spark, sf_dir):
    return enrich.complete(views.features(spark, sf_dir)).select(*FEATURE_COLUMNS, "y").persist()


def sgd_first_step(spark, sf_dir):
    """Weights after one step over the whole table, one row per input."""
    rows = _model_rows(spark, sf_dir)
    learner = LinearLearner()
    state, _ = train(rows, learner, learner.start())
    rows.unpersist()
    return rounded(_weights(to_frame(spark, [state])), "weight")


def sgd_minibatch_steps(spark, sf_dir):
    """Weights after four steps over the whole table, each on a quarter of the rows."""
    rows = enrich.complete(views.features(spark, sf_dir)).select("event_id", *FEATURE_COLUMNS, "y").persist()
    learner = LinearLearner()
    state, _ = train_minibatches(rows, learner, learner.start(), steps=4)
    rows.unpersist()
    return rounded(_weights(to_frame(spark, [state])), "weight")


def _weights(states):
    names = F.array(*[F.lit(name) for name in [*FEATURE_COLUMNS, "intercept"]])
    pairs = F.arrays_zip(names.alias("input"), F.col("weights").alias("weight"))
    return states.select(F.inline(pairs)).toDF("input", "weight")


def mlp_step(spark, sf_dir):
    """Weights of the network after one step over the whole table."""
    rows = _model_rows(spark, sf_dir)
    learner = NetworkLearner()
    state, _ = train(rows, learner, learner.start())
    rows.unpersist()
    return rounded(to_frame(spark, [state]).select(F.posexplode("weights").alias("at", "weight")), "weight")


def model_state_latest(spark, sf_dir):
    """Versions of two models saved as a table: the start, and after a step over the whole table. The newest
    version of each is read back."""
    rows, root = _model_rows(spark, sf_dir), scratch_path(spark, "models")
    for learner in (LinearLearner(), NetworkLearner()):
        state = learner.start()
        state.version = 0
        sinks.append_versions(to_frame(spark, [state]), root)
        state, _ = train(rows, learner, state)
        state.version = 1
        sinks.append_versions(to_frame(spark, [state]), root)
    rows.unpersist()
    newest = latest_models(spark.read.parquet(root))
    linear = load(newest, LinearLearner().name)
    return rounded(_weights(to_frame(spark, [linear])), "weight").crossJoin(
        newest.agg(F.count(F.lit(1)).alias("models"), F.max("version").alias("version"), F.max("seen").alias("seen")))


# -- streams -------------------------------------------------------------------------------------------

def _drained(spark, sf_dir, make, slices=SLICES):
    """Feed time slices one after the other; the query stops and restarts from its checkpoint in between."""
    source, checkpoint = scratch_path(spark, "messages"), scratch_path(spark, "checkpoint")
    for part in views.time_slices(spark, sf_dir, slices):
        part.write.mode("append").parquet(source)
        parsed = streams.parsed_stream(read_messages(spark, "parquet", path=source))
        streams.start(make(parsed, checkpoint), drain=True)


def _ntz(df, *names):
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def stream_parse_ticks(spark, sf_dir):
    target = scratch_path(prepare(spark), "parsed")

    def make(parsed, checkpoint):
        columns = parsed.select("symbol", "price", "event_time", "base", "quote")
        writer = columns.writeStream.format("parquet").option("path", target)
        return writer.option("checkpointLocation", checkpoint)

    _drained(spark, sf_dir, make)
    return _ntz(spark.read.parquet(target), "event_time")


def stream_from_latest(spark, sf_dir):
    """A stream that is started behind its first slice of messages and sees only what comes after, through restarts."""
    target, source, checkpoint = (scratch_path(prepare(spark), name) for name in ("latest", "messages", "checkpoint"))

    def opened():
        return streams.parsed_stream(read_messages(spark, "parquet", path=source))

    for at, part in enumerate(views.time_slices(spark, sf_dir, SLICES)):
        part.write.mode("append").parquet(source)
        if not streams.skip_to_latest(opened(), checkpoint):
            streams.start(streams.batches(opened(), target, checkpoint), drain=True)
    return _ntz(spark.read.parquet(target).select("event_id", "symbol", "price", "event_time"), "event_time")


def stream_parquet_roundtrip(spark, sf_dir):
    target = scratch_path(prepare(spark), "archive")
    _drained(spark, sf_dir, lambda parsed, checkpoint: streams.archive(parsed, target, checkpoint))
    return _ntz(spark.read.parquet(target), "event_time")


def stream_tumbling_avg(spark, sf_dir):
    target = scratch_path(prepare(spark), "averages")
    _drained(spark, sf_dir, lambda parsed, checkpoint: streams.average_versions(parsed, target, checkpoint, "10 minutes"))
    versions = spark.read.parquet(target)
    latest = latest_by(versions, ["window_start", "window_end", "symbol"], F.col("batch_id")).drop("batch_id")
    return rounded(_ntz(latest, "window_start", "window_end"), "avg_price")


def stream_tumbling_complete(spark, sf_dir):
    """All windows after every batch; the last batch's are the result."""
    target = scratch_path(prepare(spark), "averages")
    _drained(spark, sf_dir, lambda parsed, checkpoint: streams.averages_complete(parsed, target, checkpoint))
    written = spark.read.parquet(target)
    last = written.where(F.col("batch_id") == written.agg(F.max("batch_id")).scalar()).drop("batch_id")
    return rounded(_ntz(last, "window_start", "window_end"), "avg_price")


def stream_lag_features(spark, sf_dir):
    target, state = scratch_path(prepare(spark), "lags"), scratch_path(spark, "prices")
    _drained(spark, sf_dir, lambda parsed, checkpoint: streams.lag_stream(parsed, target, state, checkpoint))
    lags = spark.read.parquet(target).select("event_id", "symbol", "price", "price_1", "price_2", "currency_diff")
    return rounded(lags, "currency_diff")


def _delayed_slices(spark, sf_dir, count):
    """Time slices in which every 13th tick arrives one slice late, and a last one that only moves the time on."""
    slices = views.time_slices(spark, sf_dir, count)
    late = F.col("key").cast("string").cast("bigint") % 13 == 0
    held = [part.where(late) for part in slices]
    on_time = [part.where(~late) for part in slices]
    arrivals = [on_time[0], *[now.unionByName(before) for now, before in zip(on_time[1:], held)], held[-1]]
    end = views.tick_messages(spark, sf_dir).limit(1).select(
        F.lit("-1").cast("binary").alias("key"),
        F.lit('{"symbol":"END","price":0,"timestamp":"2100-01-01T00:00:00"}').cast("binary").alias("value"))
    return [*arrivals, end]


def stream_lag_state(spark, sf_dir):
    """Lags by the state operator: ticks arrive out of order over several restarts and come out in order."""
    root = scratch_path(prepare(spark), "lag-state")
    for part in _delayed_slices(spark, sf_dir, SLICES):
        part.write.mode("append").parquet(f"{root}/messages")
        parsed = streams.parsed_stream(read_messages(spark, "parquet", path=f"{root}/messages"))
        # a slice is ten days long, and a tick may be as late as two of them
        streams.start(state.lag_state_stream(
            parsed, f"{root}/lags", f"{root}/prices", f"{root}/checkpoint", "21 days", width_ms=86_400_000), drain=True)
    lags = spark.read.parquet(f"{root}/lags").select("event_id", "symbol", "price", "price_1", "price_2", "currency_diff")
    return rounded(lags, "currency_diff")


def _context(spark, sf_dir):
    """Hourly tables as an hourly job would land them; each batch opens them anew."""
    root = scratch_path(spark, "context")
    views.flat_weather(spark, sf_dir).write.parquet(f"{root}/weather")
    views.sentiment_by_hour(spark, sf_dir).write.parquet(f"{root}/sentiment")
    return lambda: (spark.read.parquet(f"{root}/weather"), spark.read.parquet(f"{root}/sentiment"))


def stream_enrich_hour(spark, sf_dir):
    target, context = scratch_path(prepare(spark), "enriched"), _context(spark, sf_dir)
    _drained(spark, sf_dir, lambda parsed, checkpoint: streams.enrich_stream(parsed, context, target, checkpoint))
    enriched = spark.read.parquet(target).select("event_id", "hour", *enrich.CONTEXT_COLUMNS)
    return rounded(enriched, *enrich.CONTEXT_COLUMNS)


def _prequential(spark, sf_dir, learner):
    """The stream fills the results table, which is then scanned by name."""
    root, context = scratch_path(prepare(spark), "online"), _context(spark, sf_dir)
    name = f"results_{root[-32:]}"
    sinks.create_results_table(spark, name, f"{root}/table", by_batch=True)

    def make(parsed, checkpoint):
        return streams.prequential_stream(parsed, context, learner, root, checkpoint, name)

    _drained(spark, sf_dir, make, slices=4)
    # The catalog lists a partitioned table's folders only when it is read, so read before it is forgotten.
    return _forget(spark, name, stage(rounded(run_query(spark, f"SELECT * FROM {name}"), "y", "y_hat")))


def stream_prequential(spark, sf_dir):
    return _prequential(spark, sf_dir, NetworkLearner())


def stream_prequential_sgd(spark, sf_dir):
    return _prequential(spark, sf_dir, LinearLearner())


QUERIES: dict[str, Query] = {
    "parse_ticks": parse_ticks,
    "split_symbol": split_symbol,
    "hour_key": hour_keys,
    "tumbling_avg": tumbling_avg,
    "lag_features": lag_features,
    "batch_delta": batch_delta,
    "batch_price_stats": batch_price_stats,
    "filter_time_range": filter_time_range,
    "series_price": series_price,
    "series_price_hourly": series_price_hourly,
    "series_price_m4": series_price_m4,
    "ndjson_scan_good": ndjson_scan_good,
    "ndjson_scan_bad": ndjson_scan_bad,
    "posts_scan": posts_scan,
    "posts_scan_multiline": posts_scan_multiline,
    "posts_scan_split": posts_scan_split,
    "posts_scan_parts": posts_scan_parts,
    "comments_to_json_parts": comments_to_json_parts,
    "comment_scores_parts": comment_scores_parts,
    "kv_upsert_parts": kv_upsert_parts,
    "lag_features_no_id": lag_features_no_id,
    "batch_delta_no_id": batch_delta_no_id,
    "batch_price_stats_no_id": batch_price_stats_no_id,
    "lag_features_cut": lag_features_cut,
    "ticks_numbered_cut": ticks_numbered_cut,
    "histogram_auto_narrowed": histogram_auto_narrowed,
    "posts_nest_from_flat": posts_nest_from_flat,
    "posts_day_band": posts_day_band,
    "newest_posts": newest_posts,
    "comment_count": comment_count,
    "comment_count_outer": comment_count_outer,
    "comment_count_flat": comment_count_flat,
    "comments_to_json": comments_to_json,
    "posts_join_comments": posts_join_comments,
    "drop_top3": drop_top3,
    "histogram_comment_count": histogram_comment_count,
    "histogram_comm_score": histogram_comm_score,
    "histogram_auto": histogram_auto,
    "file_audit": file_audit,
    "hour_partition_overwrite": hour_partition_overwrite,
    "hour_as_of_version": hour_as_of_version,
    "schema_profile": schema_profile,
    "lexicon_sentiment": lexicon_sentiment,
    "phrase_sentiment": phrase_sentiment,
    "post_scores": post_scores,
    "comment_scores": comment_scores,
    "hourly_sentiment": hourly_sentiment,
    "kv_row_cells": kv_row_cells,
    "kv_scan_posts": kv_scan_posts,
    "kv_scan_comments": kv_scan_comments,
    "kv_upsert_latest": kv_upsert_latest,
    "kv_compacted_scan": kv_compacted_scan,
    "weather_scan_hour": weather_scan_hour,
    "weather_flatten": weather_flatten,
    "weather_union_files": weather_union_files,
    "weather_pivot": weather_pivot,
    "weather_unpivot": weather_unpivot,
    "weather_pair_corr": weather_pair_corr,
    "weather_histograms": weather_histograms,
    "weather_pair_grid": weather_pair_grid,
    "posts_schema_drift": posts_schema_drift,
    "weather_union_drift": weather_union_drift,
    "forward_fill_hour": forward_fill_hour,
    "asof_hour_join": asof_hour_join,
    "forward_fill_ranges": forward_fill_ranges,
    "asof_ticks_quotes": asof_ticks_quotes,
    "asof_ticks_quotes_cut": asof_ticks_quotes_cut,
    "asof_next_quote": asof_next_quote,
    "asof_nearest_quote": asof_nearest_quote,
    "feature_table": feature_table,
    "feature_vector": feature_vector,
    "results_append": results_append,
    "results_scan": results_scan,
    "results_time_range": results_time_range,
    "results_time_bounds": results_time_bounds,
    "batch_mse": batch_mse,
    "series_prediction": series_prediction,
    "series_mse": series_mse,
    "series_sentiment": series_sentiment,
    "series_weather": series_weather,
    "sgd_first_step": sgd_first_step,
    "sgd_minibatch_steps": sgd_minibatch_steps,
    "mlp_step": mlp_step,
    "model_state_latest": model_state_latest,
    "stream_parse_ticks": stream_parse_ticks,
    "stream_from_latest": stream_from_latest,
    "stream_parquet_roundtrip": stream_parquet_roundtrip,
    "stream_tumbling_avg": stream_tumbling_avg,
    "stream_tumbling_complete": stream_tumbling_complete,
    "stream_lag_features": stream_lag_features,
    "stream_lag_state": stream_lag_state,
    "stream_enrich_hour": stream_enrich_hour,
    "stream_prequential": stream_prequential,
    "stream_prequential_sgd": stream_prequential_sgd,
}
