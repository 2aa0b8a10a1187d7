"""Per-user state rebuilt from the event history: liked set, last rating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinepulse import schema as S
from cinepulse.functions.expressions import is_action, order_key


def liked_pairs(events: DataFrame) -> DataFrame:
    """Distinct (user_id, movie_id) with a like ("ever liked": an unlike sends no
    event, so it cannot be recovered). Partial aggregation dedups map-side."""
    return events.filter(is_action(S.ACTION_LIKE)).select("user_id", "movie_id").distinct()


def latest_ratings(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Last rating per (user_id, movie_id); last write by (event_time, event_id) wins."""
    cols = [time_col, "event_id"] if "event_id" in events.columns else [time_col]
    rated = events.filter(is_action(S.ACTION_RATE) & F.col("rating_value").isNotNull())
    return rated.groupBy("user_id", "movie_id").agg(F.max_by("rating_value", order_key(cols)).alias("rating_value"))
