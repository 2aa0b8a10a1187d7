"""Catalogue statistics and the views that join live results with the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinepulse import schema as S
from cinepulse.functions.expressions import round_half_up, share_of_max
from cinepulse.functions.joins import join_bounded
from cinepulse.operators.live import genre_counts, live_order, movie_stats, top_live


def by_genre(catalog: DataFrame, genre: str = S.ALL_GENRES) -> DataFrame:
    """Catalogue rows of one genre; ``All`` passes everything (filter pushed to the scan)."""
    return catalog if genre == S.ALL_GENRES else catalog.filter(F.col("genre") == F.lit(genre))


def genre_list(catalog: DataFrame, include_all: bool = True) -> DataFrame:
    """Distinct catalogue genres, plus the ``All`` selector entry."""
    genres = catalog.select("genre").where(F.col("genre").isNotNull()).distinct()
    if not include_all:
        return genres
    return genres.unionByName(catalog.sparkSession.range(1).select(F.lit(S.ALL_GENRES).alias("genre")))


def totals(catalog: DataFrame) -> DataFrame:
    return catalog.agg(F.sum("likes").cast("long").alias("total_likes"), F.sum("views").cast("long").alias("total_views"))


def counts(catalog: DataFrame) -> DataFrame:
    """movies, genres (the genre list less its ``All`` entry)."""
    return catalog.agg(F.count(F.lit(1)).alias("movies"), F.count_distinct("genre").alias("genres"))


def _argmax(metric: str, prefix: str) -> list:
    """Row with the largest metric; on ties the last row (largest ``pos``) wins."""
    key = F.struct(F.col(metric), F.col("pos"))
    return [
        F.max_by("movie_id", key).alias(f"{prefix}_id"),
        F.max_by("title", key).alias(f"{prefix}_title"),
    ]


def extremes(catalog: DataFrame) -> DataFrame:
    """Most liked, most viewed and highest rated movie: one aggregate pass."""
    return catalog.agg(
        *_argmax("likes", "most_liked"),
        *_argmax("views", "most_viewed"),
        *_argmax("rating", "highest_rated"),
    )


def genre_share(
    events: DataFrame,
    as_of=None,
    window: str = S.DEFAULT_TRAILING,
    k: int = S.TOP_LIVE_GENRES,
    cards: int = S.TOP_GENRE_CARDS,
    time_col: str = "event_time",
) -> DataFrame:
    """Trend cards: rank, genre, score, pct_of_max = min(score / max * 100, 100),
    where max is the top score of the k rows left after the cut."""
    top = top_live(genre_counts(events, as_of, window, time_col), k).filter(F.col("position") <= cards)
    return top.select(
        F.col("position").alias("rank"),
        "genre",
        "score",
        share_of_max("score", F.col("top_score")).alias("pct_of_max"),
    )


def leaderboard(
    events: DataFrame,
    catalog: DataFrame,
    as_of=None,
    window: str = S.DEFAULT_TRAILING,
    k: int = S.TOP_LIVE_MOVIES,
    shown: int = S.TOP_LEADERBOARD,
    time_col: str = "event_time",
) -> DataFrame:
    """Top live movies, cut to ``shown`` first, then joined with the catalogue.

    Movies missing from the catalogue drop out after the cut, so fewer rows and
    skipped ranks are possible. The cut side has at most ``shown`` rows and is the
    broadcast side; the catalogue is never shipped whole.
    """
    top = top_live(movie_stats(events, as_of, window, time_col), k).filter(F.col("position") <= shown)
    cat = catalog.select("movie_id", "title", F.col("genre").alias("catalog_genre"))
    joined = join_bounded(top.select("movie_id", "position", "score", "views", "likes"), cat, "movie_id")
    return joined.select(
        F.col("position").alias("rank"),
        "movie_id",
        "title",
        F.col("catalog_genre").alias("genre"),
        round_half_up("score").alias("points"),
        "views",
        "likes",
    )


def headline_movie(
    events: DataFrame,
    catalog: DataFrame,
    as_of=None,
    window: str = S.DEFAULT_TRAILING,
    time_col: str = "event_time",
) -> DataFrame:
    """The catalogue row of the top live movie, else the catalogue's most liked
    movie (ties -> last row). One row."""
    top1 = movie_stats(events, as_of, window, time_col).orderBy(*live_order()).limit(1).select("movie_id")
    cols = ["movie_id", "title", "genre", "likes", "views"]
    live = join_bounded(top1, catalog.select(*cols), "movie_id").select(F.lit(0).alias("_pref"), *cols)
    best = catalog.agg(F.max_by(F.struct(*cols), F.struct("likes", "pos")).alias("m")).select(
        F.lit(1).alias("_pref"), *[F.col(f"m.{c}").alias(c) for c in cols]
    )
    return live.unionByName(best).orderBy("_pref").limit(1).drop("_pref")
