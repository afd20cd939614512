"""Declared schemas; nothing in a production path relies on inference."""

from pyspark.sql import types as T

TICK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
])

MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])

COMMENT = T.StructType([
    T.StructField("comm_id", T.StringType()),
    T.StructField("comm_body", T.StringType()),
    T.StructField("comm_time_utc", T.DoubleType()),
    T.StructField("comm_score", T.IntegerType()),
])

POST = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("post_title", T.StringType()),
    T.StructField("post_time", T.DoubleType()),
    T.StructField("post_score", T.IntegerType()),
    T.StructField("post_upvote", T.DoubleType()),
    T.StructField("comments", T.ArrayType(COMMENT)),
])

WEATHER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("sys", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("main", T.StructType([
        T.StructField("temp", T.DoubleType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("pressure", T.IntegerType()),
        T.StructField("feels_like", T.DoubleType()),
    ])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
])

# The five observed countries, the city suffix of their columns and the city's name.
CITIES = {
    "FR": ("paris", "Paris"),
    "GB": ("london", "London"),
    "JP": ("tokyo", "Tokyo"),
    "PL": ("wawa", "Warsaw"),
    "US": ("ny", "New York"),
}

# Column prefix of each weather measure.
MEASURES = {"tem": "temperature", "hum": "humidity", "wind": "wind_speed"}

WEATHER_COLUMNS = [f"{prefix}_{city}" for city, _ in CITIES.values() for prefix in MEASURES]
FEATURE_COLUMNS = ["currency_diff", *WEATHER_COLUMNS, "sentiment"]
RESULT_COLUMNS = [*FEATURE_COLUMNS, "y", "y_hat", "mse", "time_stamp"]

RESULTS = T.StructType(
    [T.StructField(name, T.FloatType()) for name in FEATURE_COLUMNS]
    + [T.StructField(name, T.DoubleType()) for name in ("y", "y_hat", "mse", "time_stamp")]
)

# A nested row is a post or, if the post is crowded, one part of it. A landing holds one row per hour and key.
POST_KEY = ["post_id", "part"]

MODEL_STATE = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("version", T.LongType(), False),
    T.StructField("step", T.LongType(), False),
    T.StructField("seen", T.LongType(), False),
    T.StructField("weights", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("moments", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("mean", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("spread", T.ArrayType(T.DoubleType(), False), False),
])
