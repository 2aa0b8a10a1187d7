"""cinepulse: user-activity analytics (play, like, rate) on Spark.

Subpackages: ``sources`` (topic, files, lake, versioned tables, snapshot, adapters),
``operators`` (DataFrame -> DataFrame analytics), ``functions`` (shared expressions,
clock, joins), ``streaming`` (the operators as streaming queries) and ``plans``
(registered queries, oracle SQL, runnable jobs).

The most used functions are importable from the package itself, with the call
shapes of the functions they replace (``parse_events(df)``,
``calculate_trending_genres(df, window_duration)``, ...).
"""

from cinepulse.operators.catalog import genre_share, headline_movie, leaderboard
from cinepulse.operators.ingest import encode_events, parse_events, validate_events
from cinepulse.operators.live import live_movie_scores, live_trending_genres, trending_snapshot
from cinepulse.operators.windowed import (
    calculate_engagement_score,
    calculate_trending_genres,
    engagement_scores,
    trending_genres,
)
from cinepulse.sources.kafka import read_kafka_stream, write_kafka
from cinepulse.sources.lake import read_lake, write_lake

__version__ = "0.1.0"

__all__ = [
    "calculate_engagement_score",
    "calculate_trending_genres",
    "encode_events",
    "engagement_scores",
    "genre_share",
    "headline_movie",
    "leaderboard",
    "live_movie_scores",
    "live_trending_genres",
    "parse_events",
    "read_kafka_stream",
    "read_lake",
    "trending_genres",
    "trending_snapshot",
    "validate_events",
    "write_kafka",
    "write_lake",
]
