"""The package's inputs, derived from the provided tables.

The SQL texts are valid in Spark and DuckDB, so the queries and their SQL checks start from the same
rows. ``{events}`` and ``{conversations}`` stand for the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ticktide.functions.sentiment import Rules, rules_of
from ticktide.operators.enrich import complete, feature_table
from ticktide.operators.posts import COMMENTS_PER_ROW, nest_comments
from ticktide.operators.scoring import landing_sentiment
from ticktide.operators.sides import small_side
from ticktide.operators.weather import flatten_weather
from ticktide.schemas import CITIES
from ticktide.session import prepare
from ticktide.sinks.files import BY_TASKS, overwrite_hours, overwrite_hours_by_day

TICKS = """
    SELECT event_id,
           concat(upper(event_type), CASE WHEN event_id % 10 = 0 THEN 'BTC' ELSE 'USDT' END) AS symbol,
           value AS price, ts AS event_time
    FROM {events}"""

# Two event tables for merges on time: every third event quotes a price, the others trade. Quotes are stamped by the
# minute, so that several of one symbol share a time.
TRADES = """
    SELECT event_id, symbol, price, event_time FROM ({ticks}) AS t WHERE event_id % 3 <> 0"""

QUOTES = """
    SELECT event_id AS quote_id, symbol, price * 0.99 AS bid, date_trunc('minute', event_time) AS quoted_at
    FROM ({ticks}) AS t WHERE event_id % 3 = 0"""

POSTS_FLAT = """
    SELECT CAST(conv_id AS STRING) AS post_id, text AS post_title,
           CAST(1704067200 + conv_id % 1000000000 * 3600 AS DOUBLE) AS post_time,
           CAST(length(text) % 100 AS INT) AS post_score,
           CAST(conv_id % 10 AS DOUBLE) / 10 AS post_upvote
    FROM (SELECT conv_id, turn, text FROM {conversations}
          UNION ALL SELECT 1000000000 + conv_id, turn, text FROM {conversations} WHERE conv_id % 50 = 0) AS c
    WHERE turn = 0"""

COMMENTS_FLAT = """
    SELECT CAST(conv_id AS STRING) AS post_id,
           concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING)) AS comm_id, text AS comm_body,
           CAST(1704067200 + conv_id * 3600 + turn * 60 AS DOUBLE) AS comm_time_utc,
           CAST(length(text) % 41 - 10 AS INT) AS comm_score
    FROM {conversations} WHERE turn > 0"""

WEATHER_FLAT = """
    SELECT date_trunc('hour', ts) AS hour,
           CASE user_id % 5 WHEN 0 THEN 'FR' WHEN 1 THEN 'GB' WHEN 2 THEN 'JP' WHEN 3 THEN 'PL' ELSE 'US' END
               AS country,
           min(value) + 273.15 AS temp, CAST(count(*) AS INT) * 10 AS humidity, max(value) / 10 AS wind_speed,
           CAST(1000 + count(*) AS INT) AS pressure, min(value) + 272.15 AS feels_like
    FROM {events} GROUP BY 1, 2"""

# Test weights only: the words are frequent in the provided texts.
LEXICON = """
    SELECT token, CAST(valence AS DOUBLE) AS valence
    FROM (VALUES ('the', 0.5), ('of', -0.4), ('and', 1.1), ('in', -1.3), ('to', 0.9), ('is', 1.9), ('that', -0.7),
                 ('was', -2.1), ('it', 0.3), ('for', 1.5)) AS t(token, valence)"""

# Test rules, made of frequent words as well, so that every rule family meets real rows.
RULES = """
    SELECT token, kind
    FROM (VALUES ('not', 'negator'), ('by', 'negator'), ('his', 'negator'), ('very', 'intensifier'), ('are', 'intensifier'),
                 ('this', 'intensifier'), ('hardly', 'dampener'), ('on', 'dampener'), ('as', 'dampener'),
                 ('with', 'contrast')) AS t(token, kind)"""

# Test phrases of frequent words; some begin or lie within others.
PHRASES = """
    SELECT phrase, CAST(valence AS DOUBLE) AS valence
    FROM (VALUES ('of the', 1.7), ('the of', -1.2), ('and the', 0.8), ('the and of', 2.6), ('to the', -0.9), ('the the', 1.1),
                 ('not the', 2.2), ('of the and', -2.4)) AS t(phrase, valence)"""

# Weights of the fixed linear prediction used for results: feature -> weight.
FIXED_MODEL = {"currency_diff": 0.25, "tem_paris": 0.05, "hum_tokyo": -0.01, "wind_ny": 0.1, "sentiment": 2.0}


# The producer's interface gives at most so many posts at a time.
POSTS_PER_PULL = 1000

# Declared, so that opening a table costs no schema inference.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    prepare(spark)
    used = {name: table(spark, sf_dir, name) for name in ("events", "conversations") if "{" + name + "}" in sql}
    return spark.sql(sql, **used)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, TICKS)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, TRADES.replace("{ticks}", TICKS))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _view(spark, sf_dir, QUOTES.replace("{ticks}", TICKS))
    return found.withColumn("quoted_at", F.col("quoted_at").cast("timestamp_ntz"))


def posts_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, POSTS_FLAT)


def comments_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, COMMENTS_FLAT)


def weather_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _view(spark, sf_dir, WEATHER_FLAT)
    return flat.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.sql(LEXICON)


def rules(spark: SparkSession) -> Rules:
    return rules_of(spark.sql(RULES))


def phrases(spark: SparkSession) -> DataFrame:
    return spark.sql(PHRASES)


def nested_posts(spark: SparkSession, sf_dir: str, per_row: int = COMMENTS_PER_ROW) -> DataFrame:
    return nest_comments(posts_flat(spark, sf_dir), comments_flat(spark, sf_dir), per_row)


def nested_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather in the shape of its JSON files."""
    country = F.col("country")
    name = F.coalesce(*[F.when(country == code, city) for code, (_, city) in CITIES.items()])
    return weather_flat(spark, sf_dir).select(
        "hour",
        name.alias("name"),
        F.struct(country).alias("sys"),
        F.struct("temp", "humidity", "pressure", "feels_like").alias("main"),
        F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
    )


def land_weather(spark: SparkSession, sf_dir: str, root: str) -> None:
    hourly = nested_weather(spark, sf_dir).withColumn("hour", F.date_format("hour", "yyyy-MM-dd-HH"))
    # At most one row per hour and city, so no hour can be crowded.
    overwrite_hours(hourly, root, tasks=spark.sparkContext.defaultParallelism)


def land_posts(posts: DataFrame, root: str) -> None:
    """Land posts as JSON lines, by their column ``hour`` or else by the hour of their creation, in a folder a day."""
    hour = F.date_format(F.timestamp_seconds("post_time"), "yyyy-MM-dd-HH")
    overwrite_hours_by_day(posts if "hour" in posts.columns else posts.withColumn("hour", hour), root)


def land_indented_posts(posts: DataFrame, root: str, per_file: int = POSTS_PER_PULL) -> None:
    """Land posts by day of creation as the producer writes them: indented JSON arrays of about ``per_file`` posts, one
    to a file. Each post names its hour."""
    hour = F.date_format(F.timestamp_seconds("post_time"), "yyyy-MM-dd-HH")
    daily = posts.withColumn("hour", hour).withColumn("day", F.substring("hour", 1, 10))
    pulls = daily.groupBy("day").agg(F.ceil(F.count(F.lit(1)) / per_file).alias("pulls"))
    pull = F.pmod(F.xxhash64("post_id", "part"), F.col("pulls")).alias("pull")
    record = F.struct(*posts.columns, "hour")
    files = daily.join(small_side(pulls), "day").groupBy("day", pull).agg(
        F.to_json(F.collect_list(record), {"pretty": "true"}).alias("value"))
    files.drop("pull").write.partitionBy("day").options(maxRecordsPerFile=1, **BY_TASKS).text(root)


def land_drifting_posts(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Posts of three producers, each with fields and types of its own, as JSON lines; a line of the first is broken."""
    flat = posts_flat(spark, sf_dir)
    producer = F.col("post_id").cast("bigint") % 3
    shapes = [
        F.struct("post_id", "post_title", "post_score", "post_upvote"),
        F.struct("post_id", "post_title", F.concat(F.col("post_score").cast("string"), F.lit(" points")).alias("post_score")),
        F.struct(F.col("post_id").cast("bigint").alias("post_id"), F.col("post_upvote").alias("post_score"),
                 F.lit(True).alias("pinned"), F.array("post_score").alias("tags")),
    ]
    line = F.when(F.col("post_id") == "0", F.lit("{broken"))
    for at, shape in enumerate(shapes):
        line = line.when(producer == at, F.to_json(shape))
    flat.select(line.alias("value"), producer.alias("producer")).write.partitionBy("producer").text(root)


def land_drifting_weather(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Hourly weather whose stations changed their format: every third day temperatures are text and humidity is
    missing, every other day pressures are fractions and there is a wind gust."""
    flat = weather_flat(spark, sf_dir).withColumn("day", F.dayofyear("hour"))
    when = F.date_format("hour", "yyyy-MM-dd HH").alias("hour")
    texts = F.struct(when, "country", F.col("humidity").cast("string").alias("temp"), "pressure")
    fractions = F.struct(when, "country", F.col("humidity").alias("temp"), "humidity", (F.col("pressure") + 0.5).alias("pressure"),
                         F.col("pressure").alias("gust"))
    line = F.when(F.col("day") % 3 == 0, F.to_json(texts)).otherwise(F.to_json(fractions))
    flat.select(line.alias("value"), (F.col("day") % 3 == 0).cast("string").alias("old")).write.partitionBy("old").text(root)


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as JSON messages; some are broken as a whole, some in their price."""
    when = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    price = F.when(F.col("event_id") % 101 == 0, F.lit("?")).otherwise(F.col("price").cast("string"))
    body = F.to_json(F.struct("symbol", price.alias("price"), when.alias("timestamp")))
    numeric = F.regexp_replace(body, r'"price":"([^"?]+)"', r'"price":$1')
    value = F.when(F.col("event_id") % 97 == 0, F.lit("{bad")).otherwise(numeric)
    return ticks(spark, sf_dir).select(
        F.col("event_id").cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"), "event_time"
    )


def tick_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as text lines, with a blank line behind some of them."""
    line = F.col("value").cast("string")
    blank = F.pmod(F.xxhash64("key"), F.lit(50)) == 0
    return tick_messages(spark, sf_dir).select(
        F.when(blank, F.concat(line, F.lit("\n  \n"))).otherwise(line).alias("value")
    )


def time_slices(spark: SparkSession, sf_dir: str, count: int) -> list[DataFrame]:
    """Tick messages cut by time into ``count`` batches of equal duration, oldest first."""
    messages = tick_messages(spark, sf_dir)
    low, high = messages.agg(F.min("event_time"), F.max("event_time")).first()
    step = (high - low) / count
    cuts = [low + step * at for at in range(1, count)]
    slices = []
    for at in range(count):
        part = messages
        if at:
            part = part.where(F.col("event_time") >= F.lit(cuts[at - 1]).cast("timestamp_ntz"))
        if at < count - 1:
            part = part.where(F.col("event_time") < F.lit(cuts[at]).cast("timestamp_ntz"))
        slices.append(part.select("key", "value"))
    return slices


def sentiment_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mood of every landing hour."""
    posts = posts_flat(spark, sf_dir).withColumn("part", F.lit(0))
    return landing_sentiment(posts, lexicon(spark), rules(spark))


def flat_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_weather(nested_weather(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_table(ticks(spark, sf_dir), flat_weather(spark, sf_dir), sentiment_by_hour(spark, sf_dir))


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete feature rows with the fixed linear prediction."""
    y_hat = sum((F.col(name) * F.lit(weight) for name, weight in FIXED_MODEL.items()), F.lit(0.0))
    return complete(features(spark, sf_dir)).withColumn("y_hat", y_hat)
