"""Structured Streaming wiring: the same operators, started as streaming queries.

Every query gets its own checkpoint (restart = exactly-once for the file sinks).
Ranked views are not streamed: a stream can only be sorted in complete mode, so
the aggregate is streamed and ranked on read (``operators.windowed.top_*``).

* trending: complete mode (state = one row per (window, genre), kept for ever),
  published whole on each trigger by ``foreachBatch`` as a new version of a
  versioned table (readers never see a half-written table; a replayed batch
  rewrites its own version); or, with a watermark, append mode with bounded state;
* engagement (append mode + watermark: a window is written once it is closed and
  its state is dropped, so state stays bounded however long the job runs);
* live genres over sliding windows (complete mode, like trending);
* raw lake (append, partitioned by dt and action; no state).

``state_partitions`` sets the number of state-store partitions of a stateful
query; it is fixed in the checkpoint at the first start, so size it for the state
the query will hold at full scale, not for the first batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinepulse import schema as S
from cinepulse.functions.expressions import truthy
from cinepulse.operators.ingest import intake
from cinepulse.operators.live import BUCKET_TIME, genre_buckets, movie_buckets, with_bucket_time
from cinepulse.operators.windowed import engagement_scores, top_engagement, top_trending, trending_genres
from cinepulse.sources.lake import PARTITION_COLUMNS, with_partition_columns
from cinepulse.sources.versioned import publish_each_batch, query_id

DEFAULT_TRIGGER = "30 seconds"
DEFAULT_WATERMARK = "10 minutes"


def _start(writer, trigger: str | None, query_name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    if query_name:
        writer = writer.queryName(query_name)
    if trigger is None or trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    elif trigger == "once":
        writer = writer.trigger(once=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    if not state_partitions:
        return writer.start()
    # The query clones the session (and its conf) at start; restore ours after.
    spark = getattr(writer, "_spark", None) or SparkSession.getActiveSession()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


def _watermarked(events: DataFrame, watermark: str, col: str = "event_time") -> DataFrame:
    """``withWatermark`` needs TIMESTAMP; a TIMESTAMP_NTZ event time is cast first
    (session time zone, UTC in this library)."""
    if events.schema[col].dataType.typeName() == "timestamp_ntz":
        events = events.withColumn(col, F.col(col).cast("timestamp"))
    return events.withWatermark(col, watermark)


def _append_by_day(windows: DataFrame, path: str, checkpoint: str):
    """Closed windows appended to Parquet partitioned by ``dt`` (day of window
    start), so reads of recent days prune the older ones."""
    return (
        windows.withColumn("dt", F.to_date("window_start"))
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("dt")
    )


def start_trending(
    events: DataFrame,
    out_path: str,
    checkpoint: str,
    window_duration: str = S.DEFAULT_WINDOW,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
    watermark: str | None = None,
) -> StreamingQuery:
    """Genre trend per window.

    Without ``watermark``: complete mode, the whole result rewritten on each trigger
    (every window ever seen stays in state). With ``watermark``: append mode, each
    window written once when closed and dropped from state, which is the form for a
    long-running job.
    """
    if watermark:
        agg = trending_genres(_watermarked(events, watermark), window_duration)
        writer = _append_by_day(agg, out_path, checkpoint)
    else:
        agg = trending_genres(events, window_duration)
        writer = agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(publish_each_batch(out_path))
    return _start(writer, trigger, query_name, state_partitions)


def start_engagement(
    events: DataFrame,
    out_path: str,
    checkpoint: str,
    window_duration: str = S.DEFAULT_WINDOW,
    watermark: str = DEFAULT_WATERMARK,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    agg = engagement_scores(_watermarked(events, watermark), window_duration)
    return _start(_append_by_day(agg, out_path, checkpoint), trigger, query_name, state_partitions)


def live_genre_windows(events: DataFrame, window_duration: str = "5 minutes", slide: str = "5 seconds") -> DataFrame:
    """Streaming form of the trailing view: sliding windows of truthy genres."""
    counted = events.filter(truthy("genre")).groupBy(F.window("event_time", window_duration, slide).alias("window"), F.col("genre")).agg(
        F.count(F.lit(1)).alias("score")
    )
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "genre", "score")


def start_live_genres(
    events: DataFrame,
    out_path: str,
    checkpoint: str,
    window_duration: str = "5 minutes",
    slide: str = "5 seconds",
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    agg = live_genre_windows(events, window_duration, slide)
    writer = agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(publish_each_batch(out_path))
    return _start(writer, trigger, query_name, state_partitions)


def start_live_buckets(
    events: DataFrame,
    out_path: str,
    checkpoint: str,
    bucket: str = "5 seconds",
    watermark: str = DEFAULT_WATERMARK,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
    fresh: bool = False,
) -> dict[str, StreamingQuery]:
    """Live pre-aggregation: per-bucket genre counts and movie statistics. The live
    view at any instant is then ``operators.live.live_*_from_buckets`` over a few
    buckets, with no sliding-window copies of each event.

    Default: stateful, append mode; a bucket is written once, when the watermark
    passes its end, so the table lags by the watermark delay. ``fresh=True``: no
    state; every micro-batch appends its own partial aggregates tagged with
    the query's id and ``batch_id``, so a refresh sees events of the last trigger. The readers merge the
    partial rows: they drop exact duplicates (a replayed batch writes the same rows),
    then sum. A late event is another partial row, never dropped.
    """
    if fresh:
        def write(batch: DataFrame, epoch_id: int) -> None:
            for kind, build in (("genres", genre_buckets), ("movies", movie_buckets)):
                (
                    build(batch, bucket)
                    .withColumns({"run_id": F.lit(query_id(batch)), "batch_id": F.lit(epoch_id).cast("long")})
                    .withColumn("dt", F.to_date("bucket_start"))
                    .write.mode("append")
                    .partitionBy("dt")
                    .parquet(f"{out_path}/{kind}")
                )

        writer = events.writeStream.option("checkpointLocation", f"{checkpoint}/fresh").foreachBatch(write)
        return {"fresh": _start(writer, trigger, query_name)}
    # The buckets are windows over bucket_time; the watermark must be on that column.
    timed = _watermarked(with_bucket_time(events), watermark, BUCKET_TIME)
    out = {}
    for kind, build in (("genres", genre_buckets), ("movies", movie_buckets)):
        # dt partitions: a refresh reads only the days its trailing window touches.
        agg = build(timed, bucket).withColumn("dt", F.to_date("bucket_start"))
        writer = (
            agg.writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{out_path}/{kind}")
            .option("checkpointLocation", f"{checkpoint}/{kind}")
            .partitionBy("dt")
        )
        out[kind] = _start(writer, trigger, f"{query_name}_{kind}" if query_name else None, state_partitions)
    return out


def start_raw_lake(
    events: DataFrame,
    lake_path: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
) -> StreamingQuery:
    out = with_partition_columns(events)
    writer = (
        out.writeStream.format("parquet")
        .outputMode("append")
        .option("path", lake_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITION_COLUMNS)
    )
    return _start(writer, trigger, query_name)


def start_intake(
    messages: DataFrame,
    out_path: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
) -> StreamingQuery:
    """Streaming intake: accepted and quarantined messages, partitioned by day and status."""
    writer = (
        intake(messages).withColumn("dt", F.to_date("event_time"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("dt", "status")
    )
    return _start(writer, trigger, query_name)


def _start_ranked(ranked: DataFrame, out_path: str | None, checkpoint: str, trigger, query_name, state_partitions, rows: int):
    writer = ranked.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    if out_path:
        writer = writer.foreachBatch(publish_each_batch(out_path))
    else:
        writer = writer.format("console").option("truncate", "false").option("numRows", str(rows))
    return _start(writer, trigger, query_name, state_partitions)


def start_top_trending(
    events: DataFrame,
    checkpoint: str,
    out_path: str | None = None,
    window_duration: str = S.DEFAULT_WINDOW,
    k: int = S.TOP_TRENDING,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """The reference's ranked trend view: top-k (window, genre) rows over all windows,
    re-ranked each trigger (complete mode is the only mode a stream can be sorted
    in). Console when ``out_path`` is None, else a table replaced each trigger."""
    ranked = top_trending(trending_genres(events, window_duration), k)
    return _start_ranked(ranked, out_path, checkpoint, trigger, query_name, state_partitions, k)


def start_top_engagement(
    events: DataFrame,
    checkpoint: str,
    out_path: str | None = None,
    window_duration: str = S.DEFAULT_WINDOW,
    k: int = S.TOP_ENGAGEMENT,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Top-k (window, movie, genre) engagement rows, re-ranked each trigger."""
    ranked = top_engagement(engagement_scores(events, window_duration), k)
    return _start_ranked(ranked, out_path, checkpoint, trigger, query_name, state_partitions, k)


def start_console(df: DataFrame, name: str, output_mode: str = "complete", trigger: str | None = DEFAULT_TRIGGER, rows: int = 20) -> StreamingQuery:
    """Print each trigger's result (debugging; the driver prints ``rows`` rows)."""
    writer = df.writeStream.format("console").outputMode(output_mode).option("truncate", "false").option("numRows", str(rows))
    return _start(writer, trigger, name)


def start_all(
    events: DataFrame,
    base_path: str,
    window_duration: str = S.DEFAULT_WINDOW,
    watermark: str = DEFAULT_WATERMARK,
    trigger: str | None = DEFAULT_TRIGGER,
    state_partitions: int | None = None,
    trending_append: bool = True,
) -> dict[str, StreamingQuery]:
    """The streaming job: trend, engagement and raw lake from one parsed stream.
    ``trending_append`` writes closed trend windows once (bounded state); without it
    every window is rewritten on each trigger."""
    ck = f"{base_path}/_checkpoints"
    trend_wm = watermark if trending_append else None
    return {
        "trending": start_trending(
            events, f"{base_path}/trending", f"{ck}/trending", window_duration, trigger, "trending_genres", state_partitions, trend_wm
        ),
        "engagement": start_engagement(
            events, f"{base_path}/engagement", f"{ck}/engagement", window_duration, watermark, trigger, "engagement_scores", state_partitions
        ),
        "raw_lake": start_raw_lake(events, f"{base_path}/lake", f"{ck}/raw_lake", trigger, "raw_lake"),
    }


def await_all(queries, timeout_s: float | None = None) -> None:
    """Wait for queries to finish (``availableNow``); raise the first failure."""
    for q in queries.values() if isinstance(queries, dict) else queries:
        finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
        if finished is False:
            q.stop()
            raise TimeoutError(f"streaming query {q.name or q.id} did not finish in {timeout_s}s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
