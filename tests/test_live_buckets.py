"""Live view from pre-aggregated buckets equals the raw-event live view."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cinepulse.operators import ingest, live
from cinepulse.session import fresh_path
from cinepulse.sources import files
from cinepulse.sources.adapter import activity
from cinepulse.sources.fixtures import events_df, sample_events
from cinepulse.streaming import queries as streams

from helpers import rows, t

AS_OF = dt.datetime(2024, 1, 20, 12, 0)


def test_buckets_equal_raw_events_batch(spark, sf_small):
    ev = activity(spark, sf_small)
    g, m = live.genre_buckets(ev, "1 minute"), live.movie_buckets(ev, "1 minute")
    assert rows(live.live_trending_genres_from_buckets(g, AS_OF, "1 day")) == rows(live.live_trending_genres(ev, AS_OF, "1 day"))
    assert rows(live.live_movie_scores_from_buckets(m, AS_OF, "1 day")) == rows(live.live_movie_scores(ev, AS_OF, "1 day"))


def test_bucket_boundary_is_exact(spark):
    ev = events_df(
        spark,
        [
            ("u", "play", "A", "X", t(27), None),  # exactly at the cutoff: excluded
            ("u", "play", "B", "X", t(27, 0) + dt.timedelta(microseconds=1), None),
            ("u", "play", "C", "X", t(32), None),  # exactly at as_of: included
        ],
    )
    m = live.movie_buckets(ev, "1 minute")
    assert {r.movie_id for r in live.live_movie_scores_from_buckets(m, t(32), "5 minutes").collect()} == {"B", "C"}
    assert rows(live.live_trending_genres_from_buckets(live.genre_buckets(sample_events(spark), "1 minute"), t(32))) == rows(
        live.live_trending_genres(sample_events(spark), t(32))
    )


def test_stream_writes_closed_buckets(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=2)
    stream = ingest.parse_events(files.read_message_stream(spark, src))
    out, ckpt = fresh_path(spark, "buckets"), fresh_path(spark, "ckpt")
    qs = streams.start_live_buckets(stream, out, ckpt, "1 minute", "10 minutes", trigger="availableNow", state_partitions=4)
    streams.await_all(qs, 300)
    g = spark.read.parquet(f"{out}/genres")
    # Only closed buckets are written (the newest ones wait for the watermark); the
    # live rule has no upper bound, so compare with the events up to the last closed bucket.
    closed_end = g.agg(F.max("bucket_start")).first()[0].replace(tzinfo=None) + dt.timedelta(minutes=1)
    ev = ev.filter(F.col("event_time") <= F.lit(closed_end))
    got = set(rows(live.live_trending_genres_from_buckets(g, AS_OF, "1 day", k=1000)))
    want = set(rows(live.live_trending_genres(ev, AS_OF, "1 day", k=1000)))
    assert got == want and got
    m = spark.read.parquet(f"{out}/movies")
    got_m = {(r.movie_id, r.score) for r in live.live_movie_scores_from_buckets(m, AS_OF, "1 day", k=1000).collect()}
    want_m = {(r.movie_id, r.score) for r in live.live_movie_scores(ev, AS_OF, "1 day", k=1000).collect()}
    assert got_m == want_m


def test_snapshot_from_buckets_equals_raw(spark, sf_small):
    from cinepulse.plans import jobs

    ev = activity(spark, sf_small)
    base = fresh_path(spark, "bkts")
    live.genre_buckets(ev, "1 minute").write.parquet(f"{base}/genres")
    live.movie_buckets(ev, "1 minute").write.parquet(f"{base}/movies")
    out = jobs.snapshot_refresh_from_buckets(spark, base, fresh_path(spark, "snap"), AS_OF, "1 day")
    from cinepulse.sources import snapshot

    got = sorted(rows(snapshot.read_snapshot(spark, out), "section", "position", "key", "score"))
    assert got == sorted(rows(live.trending_snapshot(ev, AS_OF, "1 day"), "section", "position", "key", "score"))


def test_bucket_table_days_pruned(spark, sf_small):
    from helpers import plan

    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=2)
    stream = ingest.parse_events(files.read_message_stream(spark, src))
    out, ckpt = fresh_path(spark, "buckets"), fresh_path(spark, "ckpt")
    streams.await_all(streams.start_live_buckets(stream, out, ckpt, "1 minute", "10 minutes", trigger="availableNow", state_partitions=4), 300)
    g = spark.read.parquet(f"{out}/genres")
    view = live.live_trending_genres_from_buckets(g, AS_OF, "1 day")
    assert "PartitionFilters: [isnotnull(dt" in plan(view)
    assert rows(view) == rows(live.live_trending_genres_from_buckets(g.drop("dt"), AS_OF, "1 day"))


def test_fresh_buckets_merge_partials_and_replays(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=4)
    stream = ingest.parse_events(files.read_message_stream(spark, src, max_files_per_trigger=1))
    out, ckpt = fresh_path(spark, "fresh-buckets"), fresh_path(spark, "ckpt")
    qs = streams.start_live_buckets(stream, out, ckpt, "1 minute", trigger="availableNow", fresh=True)
    streams.await_all(qs, 300)
    g = spark.read.parquet(f"{out}/genres")
    assert g.select("batch_id").distinct().count() == 4  # four triggers, partial rows each
    # every event counts at once (no watermark wait), the newest bucket included
    want = set(rows(live.live_trending_genres(ev, AS_OF, "1 day", k=1000)))
    assert set(rows(live.live_trending_genres_from_buckets(g, AS_OF, "1 day", k=1000))) == want
    # a replayed batch appends the same rows again: the readers drop them
    g.filter("batch_id = 0").drop("dt").withColumn("dt", F.to_date("bucket_start")).write.mode("append").partitionBy("dt").parquet(f"{out}/genres")
    g2 = spark.read.parquet(f"{out}/genres")
    assert g2.count() > g.count()
    assert set(rows(live.live_trending_genres_from_buckets(g2, AS_OF, "1 day", k=1000))) == want
    m = spark.read.parquet(f"{out}/movies")
    got_m = {(r.movie_id, r.score) for r in live.live_movie_scores_from_buckets(m, AS_OF, "1 day", k=1000).collect()}
    assert got_m == {(r.movie_id, r.score) for r in live.live_movie_scores(ev, AS_OF, "1 day", k=1000).collect()}


def test_expired_days_leave_recent_views(spark, sf_small):
    from cinepulse.plans import jobs

    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=4)
    stream = ingest.parse_events(files.read_message_stream(spark, src, max_files_per_trigger=2))
    out, ckpt = fresh_path(spark, "fresh-buckets"), fresh_path(spark, "ckpt")
    streams.await_all(streams.start_live_buckets(stream, out, ckpt, "1 hour", trigger="availableNow", fresh=True), 300)

    def view():
        g, m = spark.read.parquet(f"{out}/genres"), spark.read.parquet(f"{out}/movies")
        return (
            rows(live.live_trending_genres_from_buckets(g, AS_OF, "1 day", k=1000)),
            rows(live.live_movie_scores_from_buckets(m, AS_OF, "1 day", k=1000)),
        )

    want = view()
    gone = jobs.expire_live_buckets(spark, out, (AS_OF - dt.timedelta(days=1)).date())
    assert gone and all(f.startswith(("genres/dt=", "movies/dt=")) for f in gone)
    assert spark.read.parquet(f"{out}/genres").agg(F.min("dt")).first()[0] >= (AS_OF - dt.timedelta(days=1)).date()
    assert view() == want
    # a batch replayed after the expiry changes nothing
    g = spark.read.parquet(f"{out}/genres").filter("batch_id = 1")
    g.drop("dt").withColumn("dt", F.to_date("bucket_start")).write.mode("append").partitionBy("dt").parquet(f"{out}/genres")
    assert view() == want
    assert jobs.expire_live_buckets(spark, fresh_path(spark, "none"), "2024-02-01") == []
