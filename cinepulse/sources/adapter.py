"""Deterministic views of the driver tables in the activity model.

``events`` (event_id, ts, user_id, event_type, value, props) becomes the parsed
activity stream and ``part`` the movie catalogue:

* action: view -> play, click -> like, purchase -> rate; error and signup stay as
  unknown actions (they count for the genre trend and score 0);
* movie: the part whose key is ``props.k``; genre: its ``p_type``, NULL on every
  50th event id (exercises the null-genre rules);
* rating: ``floor(value) % 6`` (0..5) on rate events, so rating 0 occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse.functions.joins import DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_SALT_BUCKETS, lookup_join

ACTION_MAP = {"view": "play", "click": "like", "purchase": "rate"}
NULL_GENRE_EVERY = 50
RATING_LEVELS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def activity_from(
    events: DataFrame,
    part: DataFrame,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
) -> DataFrame:
    """events x part -> user_id, action, movie_id, genre, event_time, rating_value, event_id.

    The part side (key, type) is broadcast only under a checked size; a larger one
    is joined by a salted shuffle join (salt from ``event_id``), so a movie holding
    a third of all events is spread over many tasks.
    """
    # The key is read from the JSON props once per row: the one-element explode
    # keeps the join's inferred ``isnotnull(k)`` from being pushed below it as a
    # second JSON parse; filters on other columns still reach the Parquet scan.
    ev = events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.explode(F.array(F.get_json_object("props", "$.k").try_cast("long"))).alias("k"),
    )
    movies = part.select(F.col("p_partkey").alias("k"), F.col("p_type"))
    joined = lookup_join(ev, movies, "k", max_broadcast_bytes=max_broadcast_bytes, salt_buckets=salt_buckets, salt_cols=["event_id"])
    action = F.col("event_type")
    for src, dst in reversed(list(ACTION_MAP.items())):
        action = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(action)
    return joined.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        action.alias("action"),
        F.col("k").cast("string").alias("movie_id"),
        F.when(F.col("event_id") % NULL_GENRE_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_type"))
        .alias("genre"),
        F.col("ts").alias("event_time"),
        F.when(
            F.col("event_type") == "purchase",
            F.floor("value").cast("int") % F.lit(RATING_LEVELS),
        ).alias("rating_value"),
        F.col("event_id"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_from(table(spark, sf_dir, "events"), table(spark, sf_dir, "part"))


def catalog_from(part: DataFrame) -> DataFrame:
    """part -> the movie catalogue (every part is a movie)."""
    return part.select(
        F.col("p_partkey").alias("pos"),
        F.col("p_partkey").cast("string").alias("movie_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genre"),
        F.col("p_size").alias("duration"),
        F.col("p_retailprice").alias("rating"),
        ((F.col("p_partkey") * 37) % 50).alias("likes"),
        ((F.col("p_partkey") * 91) % 500).alias("views"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_from(table(spark, sf_dir, "part"))
