"""Small sample data sets (unit tests and demos only; no registered query uses them)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cinepulse import schema as S

SAMPLE_TIME = dt.datetime(2024, 1, 15, 10, 30, 0)

# The reference's ten sample events (user, action, movie, genre, rating).
SAMPLE_EVENTS = [
    ("u1", "play", "A", "Sci-Fi", None),
    ("u2", "like", "A", "Sci-Fi", None),
    ("u3", "rate", "A", "Sci-Fi", 4),
    ("u4", "play", "B", "Action", None),
    ("u1", "play", "B", "Action", None),
    ("u5", "like", "C", "Thriller", None),
    ("u2", "rate", "D", "Romance", 5),
    ("u3", "play", "E", "Horror", None),
    ("u4", "like", "F", "Comedy", None),
    ("u5", "rate", "G", "Documentary", 5),
]

# The reference's movie catalogue
# (id, title, genre, duration, year, rating, likes, views).
SAMPLE_CATALOG = [
    ("A", "Cosmic Journey", "Sci-Fi", 120, 2024, 4.5, 1250, 15000),
    ("B", "The Last Stand", "Action", 95, 2023, 4.2, 980, 12000),
    ("C", "Midnight Express", "Thriller", 108, 2024, 4.0, 750, 9000),
    ("D", "Love in Paris", "Romance", 115, 2023, 4.3, 2100, 18000),
    ("E", "Haunted Manor", "Horror", 92, 2024, 3.8, 600, 7500),
    ("F", "Comedy Night", "Comedy", 88, 2024, 4.1, 890, 11000),
    ("G", "Ocean Deep", "Documentary", 180, 2024, 4.7, 1500, 20000),
    ("H", "Dragon Quest", "Fantasy", 142, 2023, 4.4, 3200, 25000),
]

EVENT_ROW_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("movie_id", T.StringType()),
        T.StructField("genre", T.StringType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("rating_value", T.IntegerType()),
        T.StructField("event_id", T.LongType()),
    ]
)


def events_df(spark: SparkSession, rows, start_id: int = 1) -> DataFrame:
    """rows of (user, action, movie, genre, event_time, rating) -> event frame."""
    data = [(u, a, m, g, t, r, start_id + i) for i, (u, a, m, g, t, r) in enumerate(rows)]
    return spark.createDataFrame(data, EVENT_ROW_SCHEMA)


def sample_events(spark: SparkSession, at: dt.datetime = SAMPLE_TIME) -> DataFrame:
    return events_df(spark, [(u, a, m, g, at, r) for (u, a, m, g, r) in SAMPLE_EVENTS])


def sample_catalog(spark: SparkSession) -> DataFrame:
    rows = [(i, *r) for i, r in enumerate(SAMPLE_CATALOG)]
    return spark.createDataFrame(rows, S.CATALOG_SCHEMA)
