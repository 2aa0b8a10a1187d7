"""Declared schemas and the default parameters of the activity model."""

from __future__ import annotations

from pyspark.sql import types as T

# Payload of one activity message (all fields nullable, as declared by the producer).
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType(), True),
        T.StructField("action", T.StringType(), True),
        T.StructField("movie_id", T.StringType(), True),
        T.StructField("genre", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("rating_value", T.IntegerType(), True),
    ]
)

PAYLOAD_FIELDS = [f.name for f in EVENT_SCHEMA.fields]

# Fields the intake requires (rating_value is optional).
REQUIRED_FIELDS = ["user_id", "action", "movie_id", "genre", "timestamp"]

CORRUPT_COLUMN = "_corrupt_record"

# Columns of a message on the topic (Kafka source) that the pipeline reads.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.BinaryType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("pos", T.LongType(), False),
        T.StructField("movie_id", T.StringType(), False),
        T.StructField("title", T.StringType(), True),
        T.StructField("genre", T.StringType(), True),
        T.StructField("duration", T.IntegerType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("rating", T.DoubleType(), True),
        T.StructField("likes", T.LongType(), True),
        T.StructField("views", T.LongType(), True),
    ]
)

# Parameters with the reference's defaults.
DEFAULT_WINDOW = "5 minutes"
DEFAULT_TRAILING = "5 minutes"
VIEW_WEIGHT = 1.0
LIKE_WEIGHT = 2.0
RATING_WEIGHT = 5.0
TOP_TRENDING = 10
TOP_ENGAGEMENT = 20
TOP_LIVE_GENRES = 5
TOP_LIVE_MOVIES = 10
TOP_GENRE_CARDS = 8
TOP_LEADERBOARD = 5
ACTION_PLAY = "play"
ACTION_LIKE = "like"
ACTION_RATE = "rate"
ALL_GENRES = "All"
