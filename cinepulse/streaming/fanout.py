"""One read of the topic for three sinks: raw lake, trend and engagement.

Three queries on one stream read and decode the topic three times. Here one query hands each
batch, read once and persisted, to three builders: the raw rows by (dt, action part), and
mergeable partial aggregates of the batch by window (counts and sums, no averages). All
three are written to new folders, and one manifest swap publishes them with the
batch's mark: a failure between two sinks leaves nothing published, and a repeated batch
finds its mark. There is no watermark and no state; a late event is one more partial
row. Readers sum the partial rows of one manifest.

``compact`` bounds the number of files: the small parts of a sink become one part whose
files follow the bytes (raw) or the groups (partials). It reads the parts of one manifest and
swaps exactly these, so a stream may go on meanwhile, and a reader during the swap sees each
row once, before or after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cinepulse import schema as S
from cinepulse.functions.expressions import engagement_score, is_action
from cinepulse.sources import lake, manifest
from cinepulse.sources.versioned import query_id
from cinepulse.streaming.queries import DEFAULT_TRIGGER, _start

RAW, TRENDING, ENGAGEMENT = "raw", "trending", "engagement"
SINKS = (RAW, TRENDING, ENGAGEMENT)
COMPACT_PARTS = 8


def _window(events: DataFrame, duration: str) -> DataFrame:
    w = F.window("event_time", duration)
    return events.withColumns({"window_start": w["start"], "window_end": w["end"]}).filter(F.col("event_time").isNotNull())


def _partials(events: DataFrame, sink: str, duration: str) -> DataFrame:
    timed = _window(events, duration)
    if sink == TRENDING:
        return timed.filter(F.col("genre").isNotNull()).groupBy("window_start", "window_end", "genre").agg(F.count(F.lit(1)).alias("activity_count"))
    rating = F.when(is_action(S.ACTION_RATE), F.col("rating_value"))
    return timed.groupBy("window_start", "window_end", "movie_id", "genre").agg(
        F.count(F.when(is_action(S.ACTION_PLAY), F.lit(1))).alias("views"),
        F.count(F.when(is_action(S.ACTION_LIKE), F.lit(1))).alias("likes"),
        F.sum(rating).alias("rating_sum"),
        F.count(rating).alias("rating_count"),
    )


def _merged(partials: DataFrame) -> DataFrame:
    sums = [c for c in ("activity_count", "views", "likes", "rating_sum", "rating_count") if c in partials.columns]
    return partials.groupBy(*[c for c in partials.columns if c not in sums]).agg(*[F.sum(c).alias(c) for c in sums])


def _rows(events: DataFrame, sink: str, duration: str) -> DataFrame:
    return lake.with_partition_columns(events) if sink == RAW else _partials(events, sink, duration)


def _write(rows: DataFrame, sink: str, path: str) -> str:
    folder = manifest.new_folder()
    if sink == RAW:
        # Files by bytes, not one for each task, day and action.
        rows.hint("rebalance", *lake.PARTITION_COLUMNS).write.partitionBy(*lake.PARTITION_COLUMNS).parquet(f"{path}/{folder}")
    else:
        rows.write.parquet(f"{path}/{folder}")
    return folder


def write_batch(batch: DataFrame, path: str, writer: str, batch_id: int, duration: str = S.DEFAULT_WINDOW, after_sink=None) -> None:
    """Write a batch to all sinks and publish them together; ``after_sink`` is called with
    each sink's name once its files are there (tests make it fail)."""
    spark = batch.sparkSession
    if manifest.read_manifest(spark, path).holds(writer, batch_id):
        return
    once = batch.persist()
    try:
        folders = {}
        for sink in SINKS:
            folders[f"{sink}/{writer}-{batch_id}"] = _write(_rows(once, sink, duration), sink, path)
            if after_sink:
                after_sink(sink)
    finally:
        once.unpersist()

    def add(now: manifest.Manifest):
        return None if now.holds(writer, batch_id) else (now.parts | folders, now.marks | {writer: batch_id})

    manifest.update(spark, path, add)


def start_fanout(
    events: DataFrame,
    path: str,
    checkpoint: str,
    window_duration: str = S.DEFAULT_WINDOW,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
) -> StreamingQuery:
    def write(batch: DataFrame, epoch_id: int) -> None:
        write_batch(batch, path, query_id(batch), epoch_id, window_duration)

    return _start(events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), trigger, query_name)


def _schema(events_schema: T.StructType, sink: str, spark: SparkSession) -> T.StructType:
    return _rows(spark.createDataFrame([], events_schema), sink, S.DEFAULT_WINDOW).schema


def read_sink(spark: SparkSession, path: str, sink: str, events_schema: T.StructType, now: manifest.Manifest | None = None) -> DataFrame:
    """A sink's stored rows as of one manifest (by default the newest)."""
    now = now or manifest.read_manifest(spark, path)
    return manifest.read_parts(spark, path, _schema(events_schema, sink, spark), now, [p for p in now.parts if p.startswith(f"{sink}/")])


def read_trending(spark: SparkSession, path: str, events_schema: T.StructType) -> DataFrame:
    """``windowed.trending_genres`` of all events so far."""
    return _merged(read_sink(spark, path, TRENDING, events_schema))


def read_engagement(spark: SparkSession, path: str, events_schema: T.StructType) -> DataFrame:
    """``windowed.engagement_scores`` of all events so far."""
    merged = _merged(read_sink(spark, path, ENGAGEMENT, events_schema))
    mean = F.when(F.col("rating_count") > 0, F.col("rating_sum").cast("double") / F.col("rating_count")).otherwise(F.lit(0.0))
    return merged.withColumn("avg_rating", mean).withColumn("engagement_score", engagement_score()).drop("rating_sum", "rating_count")


def compact(spark: SparkSession, path: str, events_schema: T.StructType, least_parts: int = COMPACT_PARTS) -> list[str]:
    """Replace the parts of each sink that has ``least_parts`` or more by one, all sinks in one
    swap; returns those sinks (none if another compaction came first)."""
    now = manifest.read_manifest(spark, path)
    old, new = {}, {}
    for sink in SINKS:
        parts = {p: f for p, f in now.parts.items() if p.startswith(f"{sink}/")}
        if len(parts) >= max(2, least_parts):
            rows = read_sink(spark, path, sink, events_schema, now)
            folder = _write(rows if sink == RAW else _merged(rows), sink, path)
            old |= parts
            new[f"{sink}/{folder.rpartition('=')[2]}"] = folder
    if not new:
        return []

    def swap(at: manifest.Manifest):
        if any(at.parts.get(p) != f for p, f in old.items()):
            return None
        return {p: f for p, f in at.parts.items() if p not in old} | new, at.marks

    held = manifest.update(spark, path, swap).parts
    return [p.split("/")[0] for p, f in new.items() if held.get(p) == f]
