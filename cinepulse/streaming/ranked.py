"""Ranked views of closed windows: streams that run for ever with bounded state.

A window leaves the aggregate's state once the watermark passes its end. ``start_top_closed``
merges the windows closed by a batch into a table of k rows: the best k of those k rows
and the batch's own best k. Each closed window comes once, and merging the same rows again
changes nothing, so a batch that is repeated after a failure does no harm wherever it
failed. ``start_top_per_window`` chains a second aggregate behind the first one in append
mode: the most active genre of each window, with the watermark of the first carried on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinepulse import schema as S
from cinepulse.operators.windowed import engagement_scores, top_engagement, top_trending, trending_genres
from cinepulse.sources.versioned import merge_each_batch
from cinepulse.streaming.queries import DEFAULT_TRIGGER, DEFAULT_WATERMARK, _append_by_day, _start, _watermarked

#: The aggregate and the ranking of each view.
VIEWS = {"trending": (trending_genres, top_trending, S.TOP_TRENDING), "engagement": (engagement_scores, top_engagement, S.TOP_ENGAGEMENT)}


def start_top_closed(
    view: str,
    events: DataFrame,
    out_path: str,
    checkpoint: str,
    window_duration: str = S.DEFAULT_WINDOW,
    k: int | None = None,
    watermark: str = DEFAULT_WATERMARK,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """The top k rows of ``view`` over all closed windows, as a versioned table of k rows."""
    build, rank, default_k = VIEWS[view]
    k = default_k if k is None else k
    windows = build(_watermarked(events, watermark), window_duration)
    keys = [c for c in ("window_start", "window_end", "movie_id", "genre") if c in windows.columns]

    def merge(held: DataFrame | None, batch: DataFrame) -> DataFrame:
        best = rank(batch, k)
        # k + k rows: equal keys hold equal rows, one of a repeated batch.
        return best if held is None else rank(held.unionByName(best).dropDuplicates(keys), k)

    writer = windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(merge_each_batch(out_path, merge))
    return _start(writer, trigger, query_name, state_partitions)


def top_genre_stream(events: DataFrame, window_duration: str = S.DEFAULT_WINDOW, watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    """window_start, window_end, genre, activity_count: ``windowed.top_genre_per_window`` as a
    stream of two aggregates (ties: the smallest genre name)."""
    counted = (
        _watermarked(events, watermark)
        .filter(F.col("genre").isNotNull())
        .groupBy(F.window("event_time", window_duration).alias("w"), "genre")
        .agg(F.count(F.lit(1)).alias("activity_count"))
    )
    best = F.min(F.struct((-F.col("activity_count")).alias("neg"), F.col("genre").alias("genre"))).alias("best")
    top = counted.groupBy(F.window(F.window_time("w"), window_duration).alias("w")).agg(best)
    return top.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), F.col("best.genre").alias("genre"), (-F.col("best.neg")).alias("activity_count")
    )


def start_top_per_window(
    events: DataFrame,
    out_path: str,
    checkpoint: str,
    window_duration: str = S.DEFAULT_WINDOW,
    watermark: str = DEFAULT_WATERMARK,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Each closed window's most active genre, appended once."""
    writer = _append_by_day(top_genre_stream(events, window_duration, watermark), out_path, checkpoint)
    return _start(writer, trigger, query_name, state_partitions)
