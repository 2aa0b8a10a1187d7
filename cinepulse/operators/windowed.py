"""Tumbling-window analytics (the streaming job's family).

Aggregations are plain ``groupBy(window, ...)`` so they run unchanged on batch and
streaming frames: partial aggregation on the map side, one hash exchange on the
group keys, final aggregation. Ranking is kept in separate functions because a
stream can be sorted only in complete mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinepulse import schema as S
from cinepulse.functions.expressions import engagement_score, is_action


def _flat_window(time_col: str, duration: str, slide: str | None = None) -> Column:
    return F.window(F.col(time_col), duration, slide) if slide else F.window(F.col(time_col), duration)


def _unwrap_window(df: DataFrame, rest: list[str]) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )


def trending_genres(events: DataFrame, window_duration: str = S.DEFAULT_WINDOW, time_col: str = "event_time", slide: str | None = None) -> DataFrame:
    """Rows per (window, genre); every action counts; NULL genre left out, ``""`` kept."""
    agg = (
        events.filter(F.col("genre").isNotNull())
        .groupBy(_flat_window(time_col, window_duration, slide).alias("window"), F.col("genre"))
        .agg(F.count(F.lit(1)).alias("activity_count"))
    )
    return _unwrap_window(agg, ["genre", "activity_count"])


def engagement_metrics(grouped) -> DataFrame:
    """views, likes, avg_rating (rating 0 averaged, no rating -> 0.0), engagement_score."""
    agg = grouped.agg(
        F.count(F.when(is_action(S.ACTION_PLAY), F.lit(1))).alias("views"),
        F.count(F.when(is_action(S.ACTION_LIKE), F.lit(1))).alias("likes"),
        F.avg(F.when(is_action(S.ACTION_RATE), F.col("rating_value"))).alias("avg_rating"),
    )
    agg = agg.withColumn("avg_rating", F.coalesce(F.col("avg_rating"), F.lit(0.0)))
    return agg.withColumn("engagement_score", engagement_score())


def engagement_scores(events: DataFrame, window_duration: str = S.DEFAULT_WINDOW, time_col: str = "event_time") -> DataFrame:
    """Per (window, movie_id, genre); a NULL genre is a group of its own."""
    grouped = events.groupBy(_flat_window(time_col, window_duration).alias("window"), F.col("movie_id"), F.col("genre"))
    return _unwrap_window(
        engagement_metrics(grouped),
        ["movie_id", "genre", "views", "likes", "avg_rating", "engagement_score"],
    )


# Total orders for the rankings (the reference leaves ties open).
def trending_order() -> list[Column]:
    return [F.col("activity_count").desc(), F.col("window_start").asc(), F.col("genre").asc_nulls_first()]


def engagement_order() -> list[Column]:
    return [
        F.col("engagement_score").desc(),
        F.col("window_start").asc(),
        F.col("movie_id").asc_nulls_first(),
        F.col("genre").asc_nulls_first(),
    ]


def top_trending(trending: DataFrame, k: int = S.TOP_TRENDING) -> DataFrame:
    """Global top-k (window, genre) rows: a TakeOrderedAndProject, no global sort."""
    return trending.orderBy(*trending_order()).limit(k)


def top_engagement(engagement: DataFrame, k: int = S.TOP_ENGAGEMENT) -> DataFrame:
    return engagement.orderBy(*engagement_order()).limit(k)


def top_genre_per_window(trending: DataFrame) -> DataFrame:
    """The most active genre of each window (ties -> smallest genre name).

    An aggregate, not a ranking window: ``min(struct(-count, genre))`` per window
    picks the row and is combined on the map side before the shuffle.
    """
    best = F.min(F.struct((-F.col("activity_count")).alias("neg_count"), F.col("genre").alias("genre")))
    return (
        trending.groupBy("window_start", "window_end")
        .agg(best.alias("best"))
        .select(
            "window_start",
            "window_end",
            F.col("best.genre").alias("genre"),
            (-F.col("best.neg_count")).alias("activity_count"),
        )
    )


def calculate_trending_genres(events: DataFrame, window_duration: str = S.DEFAULT_WINDOW, k: int = S.TOP_TRENDING) -> DataFrame:
    """Batch form of the reference's function: aggregate then top-k."""
    return top_trending(trending_genres(events, window_duration), k)


def calculate_engagement_score(events: DataFrame, window_duration: str = S.DEFAULT_WINDOW, k: int = S.TOP_ENGAGEMENT) -> DataFrame:
    return top_engagement(engagement_scores(events, window_duration), k)
