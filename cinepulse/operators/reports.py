"""Daily and monthly engagement reports (batch work over the lake).

Same rules as the windowed family, grouped by calendar day or month, movie and
genre. Run them on ``sources.lake.read_lake(...)`` with a ``dt`` range so only
the needed partitions are scanned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinepulse.operators.windowed import engagement_metrics

METRICS = ["views", "likes", "avg_rating", "engagement_score"]


def daily_report(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    day = F.to_date(F.col(time_col)).alias("day")
    return engagement_metrics(events.groupBy(day, F.col("movie_id"), F.col("genre"))).select("day", "movie_id", "genre", *METRICS)


def monthly_report(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    month = F.trunc(F.to_date(F.col(time_col)), "month").alias("month")
    return engagement_metrics(events.groupBy(month, F.col("movie_id"), F.col("genre"))).select("month", "movie_id", "genre", *METRICS)
