"""Trailing-window ("last 5 minutes at an instant") analytics: the live family.

Rules differ from the windowed family on purpose: strings count only when truthy
(not NULL, not empty), a rating counts only when truthy (not NULL, not 0), a movie
is grouped by id alone and keeps the genre of its first event, and ties in the
top-k keep first-seen order. The trailing predicate is ``event_time > as_of -
trailing`` (strict, no upper bound: future rows pass).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinepulse import schema as S
from cinepulse.functions.clock import as_of_column
from cinepulse.functions.expressions import engagement_score, interval, is_action, order_key, truthy


def _order_cols(events: DataFrame, time_col: str) -> list[str]:
    return [time_col, "event_id"] if "event_id" in events.columns else [time_col]


def trailing(events: DataFrame, as_of=None, window: str = S.DEFAULT_TRAILING, time_col: str = "event_time") -> DataFrame:
    """Rows with ``time_col > as_of - window``; NULL times drop out."""
    stamp = as_of_column(events, as_of, time_col)
    return events.filter(F.col(time_col) > stamp - interval(window))


def genre_counts(events: DataFrame, as_of=None, window: str = S.DEFAULT_TRAILING, time_col: str = "event_time") -> DataFrame:
    """genre, score (events in the trailing window), first_seen (order key)."""
    recent = trailing(events, as_of, window, time_col).filter(truthy("genre"))
    return recent.groupBy("genre").agg(
        F.count(F.lit(1)).alias("score"),
        F.min(order_key(_order_cols(events, time_col))).alias("first_seen"),
    )


def movie_stats(events: DataFrame, as_of=None, window: str = S.DEFAULT_TRAILING, time_col: str = "event_time") -> DataFrame:
    """movie_id, genre (first seen), score, views, likes, avg_rating, first_seen."""
    recent = trailing(events, as_of, window, time_col).filter(truthy("movie_id"))
    first = order_key(_order_cols(events, time_col))
    rated = is_action(S.ACTION_RATE) & F.col("rating_value").isNotNull() & (F.col("rating_value") != 0)
    agg = recent.groupBy("movie_id").agg(
        F.min_by(F.col("genre"), first).alias("genre"),
        F.count(F.when(is_action(S.ACTION_PLAY), F.lit(1))).alias("views"),
        F.count(F.when(is_action(S.ACTION_LIKE), F.lit(1))).alias("likes"),
        F.sum(F.when(rated, F.col("rating_value"))).alias("total_rating"),
        F.count(F.when(rated, F.lit(1))).alias("rating_count"),
        F.min(first).alias("first_seen"),
    )
    avg = F.when(F.col("rating_count") > 0, F.col("total_rating").cast("double") / F.col("rating_count")).otherwise(F.lit(0.0))
    return agg.withColumn("avg_rating", avg).select(
        "movie_id",
        "genre",
        engagement_score().alias("score"),
        "views",
        "likes",
        "avg_rating",
        "first_seen",
    )


def live_order() -> list[Column]:
    return [F.col("score").desc(), F.col("first_seen").asc()]


def top_live(df: DataFrame, k: int) -> DataFrame:
    """Top-k by (score desc, first_seen) with ``position`` 1..k and ``top_score``.

    The cut is a TakeOrderedAndProject (k rows per task, then a merge). The at most
    k rows left are numbered inside one small aggregate (sorted array, then
    ``posexplode``) instead of an unpartitioned window; ``top_score`` is the score
    at position 1. An empty input gives no rows.
    """
    cols = df.columns
    top = df.orderBy(*live_order()).limit(k)
    key = F.struct((-F.col("score")).alias("neg_score"), F.col("first_seen").alias("first"), F.struct(*cols).alias("row"))
    packed = top.agg(F.sort_array(F.collect_list(key)).alias("ranked"))
    numbered = packed.select(
        F.posexplode("ranked").alias("pos", "r"),
        F.element_at("ranked", 1)["row"]["score"].alias("top_score"),
    )
    return numbered.select((F.col("pos") + 1).cast("int").alias("position"), "r.row.*", "top_score")


def live_trending_genres(events: DataFrame, as_of=None, window: str = S.DEFAULT_TRAILING, k: int = S.TOP_LIVE_GENRES, time_col: str = "event_time") -> DataFrame:
    return top_live(genre_counts(events, as_of, window, time_col), k).select("genre", "score")


def live_movie_scores(events: DataFrame, as_of=None, window: str = S.DEFAULT_TRAILING, k: int = S.TOP_LIVE_MOVIES, time_col: str = "event_time") -> DataFrame:
    return top_live(movie_stats(events, as_of, window, time_col), k).select(
        "movie_id", "genre", "score", "views", "likes", "avg_rating"
    )


def trending_snapshot(
    events: DataFrame,
    as_of=None,
    window: str = S.DEFAULT_TRAILING,
    k_genres: int = S.TOP_LIVE_GENRES,
    k_movies: int = S.TOP_LIVE_MOVIES,
    time_col: str = "event_time",
) -> DataFrame:
    """Both live lists in long form: section, position, key, score."""
    genres = top_live(genre_counts(events, as_of, window, time_col), k_genres).select(
        F.lit("trending_genres").alias("section"),
        "position",
        F.col("genre").alias("key"),
        F.col("score").cast("double").alias("score"),
    )
    movies = top_live(movie_stats(events, as_of, window, time_col), k_movies).select(
        F.lit("movie_scores").alias("section"),
        "position",
        F.col("movie_id").alias("key"),
        "score",
    )
    return genres.unionByName(movies)


def trending_snapshot_nested(
    events: DataFrame,
    as_of=None,
    window: str = S.DEFAULT_TRAILING,
    k_genres: int = S.TOP_LIVE_GENRES,
    k_movies: int = S.TOP_LIVE_MOVIES,
    time_col: str = "event_time",
) -> DataFrame:
    """One row: trending_genres ARRAY<STRUCT<genre,score>>, movie_scores ARRAY<STRUCT<...>>
    (the response shape); arrays hold at most k rows each."""
    genres = top_live(genre_counts(events, as_of, window, time_col), k_genres).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("position", "genre", "score"))),
            lambda s: F.struct(s["genre"].alias("genre"), s["score"].alias("score")),
        ).alias("trending_genres")
    )
    movies = top_live(movie_stats(events, as_of, window, time_col), k_movies).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("position", "movie_id", "genre", "score", "views", "likes", "avg_rating"))),
            lambda s: F.struct(*[s[c].alias(c) for c in ("movie_id", "genre", "score", "views", "likes", "avg_rating")]),
        ).alias("movie_scores")
    )
    # Two one-row frames -> one row, by a union and one aggregate (no join).
    both = genres.unionByName(movies, allowMissingColumns=True)
    return both.agg(
        F.first("trending_genres", ignorenulls=True).alias("trending_genres"),
        F.first("movie_scores", ignorenulls=True).alias("movie_scores"),
    )


def health_counts(events: DataFrame, as_of=None, window: str = S.DEFAULT_TRAILING, time_col: str = "event_time") -> DataFrame:
    """events_processed (all rows) and events_in_window (rows in the trailing window)."""
    stamp = as_of_column(events, as_of, time_col)
    in_window = F.col(time_col) > stamp - interval(window)
    return events.agg(
        F.count(F.lit(1)).alias("events_processed"),
        F.count(F.when(in_window, F.lit(1))).alias("events_in_window"),
    )


# --- pre-aggregated time buckets ---------------------------------------------
# A trailing window recomputed every few seconds does not need the raw events:
# per-bucket partial aggregates (written once, by a streaming query in append
# mode) are summed over the buckets inside the window. Buckets are (start, end]
# in event time, so the buckets with ``bucket_start >= as_of - window`` hold exactly
# the events with ``event_time > as_of - window`` whenever that instant is a bucket
# boundary (refresh on bucket boundaries); otherwise the window is rounded to whole
# buckets. The first-seen merge (``min_by`` over the order key) is exact.

BUCKET_TIME = "bucket_time"


def with_bucket_time(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Adds ``bucket_time`` = event time - 1 us: windows over it are (start, end]
    in event time. A stream puts its watermark on this column."""
    return events.withColumn(BUCKET_TIME, F.col(time_col) - F.expr("INTERVAL 1 MICROSECOND"))


def _bucket(events: DataFrame, bucket: str, time_col: str) -> tuple[DataFrame, Column]:
    ev = events if BUCKET_TIME in events.columns else with_bucket_time(events, time_col)
    return ev, F.window(F.col(BUCKET_TIME), bucket)


def genre_figures(events: DataFrame, time_col: str = "event_time") -> list[Column]:
    """The partial aggregates of a genre: score, first_seen."""
    return [F.count(F.lit(1)).alias("score"), F.min(order_key(_order_cols(events, time_col))).alias("first_seen")]


def movie_figures(events: DataFrame, time_col: str = "event_time") -> list[Column]:
    """The partial aggregates of a movie: genre (first seen), counts, ratings, first_seen."""
    first = order_key(_order_cols(events, time_col))
    rated = is_action(S.ACTION_RATE) & F.col("rating_value").isNotNull() & (F.col("rating_value") != 0)
    return [
        F.min_by(F.col("genre"), first).alias("genre"),
        F.count(F.when(is_action(S.ACTION_PLAY), F.lit(1))).alias("views"),
        F.count(F.when(is_action(S.ACTION_LIKE), F.lit(1))).alias("likes"),
        F.sum(F.when(rated, F.col("rating_value"))).alias("total_rating"),
        F.count(F.when(rated, F.lit(1))).alias("rating_count"),
        F.min(first).alias("first_seen"),
    ]


def genre_buckets(events: DataFrame, bucket: str = "5 seconds", time_col: str = "event_time") -> DataFrame:
    """bucket_start, genre, score, first_seen: live genre counts per time bucket."""
    ev, win = _bucket(events, bucket, time_col)
    agg = ev.filter(truthy("genre")).groupBy(win.alias("b"), "genre").agg(*genre_figures(events, time_col))
    return agg.select(F.col("b.start").alias("bucket_start"), "genre", "score", "first_seen")


def movie_buckets(events: DataFrame, bucket: str = "5 seconds", time_col: str = "event_time") -> DataFrame:
    """bucket_start, movie_id, genre (first seen in the bucket), views, likes,
    total_rating, rating_count, first_seen: live movie statistics per time bucket."""
    ev, win = _bucket(events, bucket, time_col)
    agg = ev.filter(truthy("movie_id")).groupBy(win.alias("b"), "movie_id").agg(*movie_figures(events, time_col))
    return agg.select(F.col("b.start").alias("bucket_start"), "movie_id", "genre", "views", "likes", "total_rating", "rating_count", "first_seen")


def _recent_buckets(buckets: DataFrame, as_of, window: str) -> DataFrame:
    stamp = as_of_column(None, as_of) if as_of is not None else buckets.select(F.max("bucket_start")).scalar()
    cutoff = stamp - interval(window)
    recent = buckets.filter(F.col("bucket_start") >= cutoff)
    if "dt" in buckets.columns:  # a dt-partitioned bucket table: prune whole days
        recent = recent.filter(F.col("dt") >= F.to_date(cutoff))
    if "batch_id" in buckets.columns:  # per-batch partial rows: a replayed batch repeats its rows
        recent = recent.dropDuplicates()
    return recent


def _merge_genre_buckets(genre_bkts: DataFrame, as_of, window: str) -> DataFrame:
    return _recent_buckets(genre_bkts, as_of, window).groupBy("genre").agg(
        F.sum("score").alias("score"), F.min("first_seen").alias("first_seen")
    )


def _merge_movie_buckets(movie_bkts: DataFrame, as_of, window: str) -> DataFrame:
    merged = _recent_buckets(movie_bkts, as_of, window).groupBy("movie_id").agg(
        F.min_by("genre", F.col("first_seen")).alias("genre"),
        F.sum("views").alias("views"),
        F.sum("likes").alias("likes"),
        F.sum("total_rating").alias("total_rating"),
        F.sum("rating_count").alias("rating_count"),
        F.min("first_seen").alias("first_seen"),
    )
    avg = F.when(F.col("rating_count") > 0, F.col("total_rating").cast("double") / F.col("rating_count")).otherwise(F.lit(0.0))
    return merged.withColumn("avg_rating", avg).withColumn("score", engagement_score())


def live_trending_genres_from_buckets(genre_bkts: DataFrame, as_of, window: str = S.DEFAULT_TRAILING, k: int = S.TOP_LIVE_GENRES) -> DataFrame:
    return top_live(_merge_genre_buckets(genre_bkts, as_of, window), k).select("genre", "score")


def live_movie_scores_from_buckets(movie_bkts: DataFrame, as_of, window: str = S.DEFAULT_TRAILING, k: int = S.TOP_LIVE_MOVIES) -> DataFrame:
    return top_live(_merge_movie_buckets(movie_bkts, as_of, window), k).select(
        "movie_id", "genre", "score", "views", "likes", "avg_rating"
    )


def trending_snapshot_from_buckets(
    genre_bkts: DataFrame,
    movie_bkts: DataFrame,
    as_of,
    window: str = S.DEFAULT_TRAILING,
    k_genres: int = S.TOP_LIVE_GENRES,
    k_movies: int = S.TOP_LIVE_MOVIES,
) -> DataFrame:
    """``trending_snapshot`` (long form) computed from the bucket tables."""
    genres = top_live(_merge_genre_buckets(genre_bkts, as_of, window), k_genres).select(
        F.lit("trending_genres").alias("section"), "position", F.col("genre").alias("key"), F.col("score").cast("double").alias("score")
    )
    movies = top_live(_merge_movie_buckets(movie_bkts, as_of, window), k_movies).select(
        F.lit("movie_scores").alias("section"), "position", F.col("movie_id").alias("key"), "score"
    )
    return genres.unionByName(movies)
