"""Streaming: batch equals stream, late data, restart, three queries on one stream."""

from __future__ import annotations

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from cinepulse.operators import ingest, windowed
from cinepulse.session import fresh_path, local_fs_path
from cinepulse.sources import files, lake
from cinepulse.sources.adapter import activity
from cinepulse.sources.fixtures import events_df
from cinepulse.sources.versioned import read_latest
from cinepulse.streaming import queries as streams
from cinepulse.streaming.health import ProgressTotals

from helpers import rows

BASE = dt.datetime(2024, 1, 15, 0, 0)


def _write_ordered(spark, path, batches):
    """One Parquet file per batch of events, with increasing modification times."""
    for i, evs in enumerate(batches):
        sub = f"{path}/b{i:03d}"
        files.write_messages(ingest.to_messages(events_df(spark, evs, start_id=100 * i)).coalesce(1), sub)
        for name in os.listdir(local_fs_path(sub)):
            full = os.path.join(local_fs_path(sub), name)
            if name.endswith(".parquet"):
                os.rename(full, os.path.join(local_fs_path(path), f"{i:03d}-{name}"))
        stamp = time.time() - 1000 + 10 * i
        for name in os.listdir(local_fs_path(path)):
            if name.startswith(f"{i:03d}-"):
                os.utime(os.path.join(local_fs_path(path), name), (stamp, stamp))


def test_trending_stream_equals_batch(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=4)
    stream = ingest.parse_events(files.read_message_stream(spark, src, max_files_per_trigger=1))
    out, ckpt = fresh_path(spark, "trend"), fresh_path(spark, "ckpt")
    q = streams.start_trending(stream, out, ckpt, "5 minutes", trigger="availableNow")
    streams.await_all([q], 300)
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) >= 2  # incremental state used
    got = read_latest(spark, out).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "genre", "activity_count")
    want = windowed.trending_genres(ev).select("window_start", "genre", "activity_count")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_watermark_drops_late_rows(spark):
    src = fresh_path(spark, "late")
    os.makedirs(local_fs_path(src))
    at = lambda m: BASE + dt.timedelta(minutes=m)
    _write_ordered(
        spark,
        src,
        [
            [("u", "play", "A", "X", at(1), None)],
            [("u", "play", "A", "X", at(30), None)],  # moves the watermark to 00:20
            [("u", "play", "B", "X", at(31), None)],
            [("u", "play", "A", "X", at(2), None)],  # late: window 00:00-00:05 already closed
        ],
    )
    stream = ingest.parse_events(files.read_message_stream(spark, src, max_files_per_trigger=1))
    out, ckpt = fresh_path(spark, "eng"), fresh_path(spark, "ckpt")
    totals = ProgressTotals(spark).attach()
    q = streams.start_engagement(stream, out, ckpt, "5 minutes", "10 minutes", trigger="availableNow")
    streams.await_all([q], 300)
    got = rows(spark.read.parquet(out), "movie_id", "views")
    assert got == [("A", 1)]  # only the closed window, without the late row
    totals.wait(q).detach()
    assert totals.late_rows_dropped(q) == 1
    assert totals.events_processed(q) == 4


def test_raw_lake_restart_no_duplicates(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=2)
    path, ckpt = fresh_path(spark, "lake"), fresh_path(spark, "ckpt")

    def run():
        stream = ingest.parse_events(files.read_message_stream(spark, src, max_files_per_trigger=1))
        streams.await_all([streams.start_raw_lake(stream, path, ckpt, trigger="availableNow")], 300)
        return lake.read_lake(spark, path).count()

    assert run() == ev.count()
    assert run() == ev.count()  # restart on the same checkpoint: nothing re-added
    extra = ev.limit(7)  # a new file lands; only its rows are added
    files.write_messages(ingest.to_messages(extra), src)
    assert run() == ev.count() + 7


def test_three_queries_one_stream(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=2)
    stream = ingest.parse_events(files.read_message_stream(spark, src))
    base = fresh_path(spark, "job")
    qs = streams.start_all(stream, base, "1 day", "10 minutes", trigger="availableNow")
    streams.await_all(qs, 300)
    assert spark.read.parquet(f"{base}/trending").count() > 0
    assert spark.read.parquet(f"{base}/engagement").count() > 0
    assert lake.read_lake(spark, f"{base}/lake").count() == ev.count()


def test_live_sliding_windows(spark):
    at = lambda m: BASE + dt.timedelta(minutes=m)
    src = fresh_path(spark, "live")
    os.makedirs(local_fs_path(src))
    _write_ordered(spark, src, [[("u", "play", "A", "X", at(7), None), ("u", "play", "A", "", at(8), None)]])
    stream = ingest.parse_events(files.read_message_stream(spark, src))
    out, ckpt = fresh_path(spark, "livew"), fresh_path(spark, "ckpt")
    streams.await_all([streams.start_live_genres(stream, out, ckpt, "10 minutes", "5 minutes", trigger="availableNow")], 300)
    got = sorted((r.window_start.replace(tzinfo=None), r.genre, r.score) for r in read_latest(spark, out).collect())
    assert got == [(at(0), "X", 1), (at(5), "X", 1)]


def test_trending_append_mode_closed_windows(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=2)
    stream = ingest.parse_events(files.read_message_stream(spark, src))
    out, ckpt = fresh_path(spark, "trend"), fresh_path(spark, "ckpt")
    q = streams.start_trending(stream, out, ckpt, "1 day", trigger="availableNow", watermark="10 minutes", state_partitions=4)
    streams.await_all([q], 300)
    got = spark.read.parquet(out).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "genre", "activity_count")
    cutoff = ev.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)
    want = windowed.trending_genres(ev, "1 day").filter(F.col("window_end") <= F.lit(cutoff)).select("window_start", "genre", "activity_count")
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_processing_time_trigger(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=2)
    stream = ingest.parse_events(files.read_message_stream(spark, src))
    path, ckpt = fresh_path(spark, "lake"), fresh_path(spark, "ckpt")
    q = streams.start_raw_lake(stream, path, ckpt, trigger="1 second", query_name="raw_lake_periodic")
    try:
        q.processAllAvailable()
        assert q.isActive and q.name == "raw_lake_periodic"
    finally:
        q.stop()
    assert lake.read_lake(spark, path).count() == ev.count()


def test_ranked_stream_equals_batch_topk(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=4)
    stream = ingest.parse_events(files.read_message_stream(spark, src, max_files_per_trigger=2))
    out, ckpt = fresh_path(spark, "top"), fresh_path(spark, "ckpt")
    streams.await_all([streams.start_top_trending(stream, ckpt, out, "5 minutes", 10, trigger="availableNow", state_partitions=4)], 300)
    got = [(r.window_start.replace(tzinfo=None), r.genre, r.activity_count) for r in read_latest(spark, out).collect()]
    want = rows(windowed.calculate_trending_genres(ev, "5 minutes", 10), "window_start", "genre", "activity_count")
    assert sorted(got) == sorted(want)
    ckpt2 = fresh_path(spark, "ckpt")
    stream2 = ingest.parse_events(files.read_message_stream(spark, src))
    totals = ProgressTotals(spark).attach()
    q = streams.start_top_engagement(stream2, ckpt2, None, "5 minutes", 5, trigger="availableNow", state_partitions=4)
    streams.await_all([q], 300)  # console sink: the ranked view prints each trigger
    totals.wait(q).detach()
    assert totals.events_processed(q) == ev.count()


def test_complete_mode_table_is_versioned(spark, sf_small):
    import os

    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=4)
    stream = ingest.parse_events(files.read_message_stream(spark, src, max_files_per_trigger=1))
    out, ckpt = fresh_path(spark, "trend"), fresh_path(spark, "ckpt")
    streams.await_all([streams.start_trending(stream, out, ckpt, "1 day", trigger="availableNow", state_partitions=4)], 300)
    versions = sorted(d for d in os.listdir(local_fs_path(out)) if d.startswith("version="))
    assert len(versions) == 2  # four triggers published, the two newest kept
    assert read_latest(spark, out).count() == windowed.trending_genres(ev, "1 day").count()


def test_watermark_accepts_ntz_event_time(spark, sf_small):
    # events with a TIMESTAMP_NTZ event time (the adapter's type), streamed from Parquet
    ev = activity(spark, sf_small)
    src = fresh_path(spark, "ntz-events")
    ev.write.parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    out, ckpt = fresh_path(spark, "eng"), fresh_path(spark, "ckpt")
    streams.await_all([streams.start_engagement(stream, out, ckpt, "1 day", "10 minutes", trigger="availableNow", state_partitions=4)], 300)
    assert spark.read.parquet(out).count() > 0


def test_console_sink(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"))
    stream = ingest.parse_events(files.read_message_stream(spark, src))
    totals = ProgressTotals(spark).attach()
    q = streams.start_console(windowed.trending_genres(stream, "1 day"), "trend_console", trigger="availableNow", rows=5)
    streams.await_all([q], 300)
    totals.wait(q).detach()
    assert q.name == "trend_console" and totals.events_processed(q) == ev.count()


def test_totals_outlive_reports_and_runs(spark):
    src, path = fresh_path(spark, "totals-src"), fresh_path(spark, "totals")
    schema = "value binary, timestamp timestamp"
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        ckpt, out, total = fresh_path(spark, "ckpt"), fresh_path(spark, "out"), 0
        for n in (5, 2):  # two runs on one checkpoint, one batch a file
            for i in range(n):
                spark.createDataFrame([(bytearray(b"{}"), BASE)] * 10, schema).coalesce(1).write.mode("append").parquet(src)
            total += 10 * n
            totals = ProgressTotals(spark, path).attach()
            stream = ingest.parse_events(files.read_message_stream(spark, src, max_files_per_trigger=1))
            q = streams.start_raw_lake(stream, out, ckpt, trigger="availableNow")
            streams.await_all([q], 300)
            totals.wait(q).detach()
            assert totals.events_processed(q) == total
        assert ProgressTotals(spark, path).events_processed(str(q.id)) == total
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
