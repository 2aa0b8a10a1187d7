"""Streams that run for ever: keyed state, ranked closed windows, one read for three sinks."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cinepulse.operators import state, windowed
from cinepulse.session import fresh_path, local_fs_path
from cinepulse.sources import files, lake, manifest
from cinepulse.sources.adapter import activity
from cinepulse.sources.fixtures import events_df
from cinepulse.sources.versioned import read_latest
from cinepulse.streaming import fanout, ranked, user_state
from cinepulse.streaming import queries as streams

from helpers import rows

AT = dt.datetime(2024, 1, 15)


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def events(spark, sf_small):
    return activity(spark, sf_small).cache()


@pytest.fixture(scope="module")
def replay(spark, events):
    """The events as files in time order."""
    path = fresh_path(spark, "replay")
    files.write_replay(events, path, "event_time", rows_per_file=100, min_files=2)
    return path


def _stream(spark, events, path, per_trigger=3):
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", str(per_trigger)).parquet(path)


# --- replay -------------------------------------------------------------------------


def test_replay_is_read_in_time_order(spark, events):
    path = fresh_path(spark, "replay")
    n = files.write_replay(events, path, "event_time", rows_per_file=150, min_files=3)
    assert n >= events.count() / 150  # follows the rows
    seen = []
    q = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(path)
        .writeStream.option("checkpointLocation", fresh_path(spark, "ckpt")).trigger(availableNow=True)
        .foreachBatch(lambda b, _: seen.append(b.agg(F.min("event_time"), F.max("event_time"), F.count("*")).first())).start()
    )
    streams.await_all([q], 300)
    seen = [tuple(r) for r in seen if r[2]]
    assert len(seen) > 1 and sum(r[2] for r in seen) == events.count()
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))


# --- per-user state -------------------------------------------------------------------


def test_user_state_over_batches_and_a_restart(spark, events):
    src, out, ckpt = (fresh_path(spark, x) for x in ("src", "state", "ckpt"))
    cut = AT
    early, late = events.filter(F.col("event_time") < F.lit(cut)), events.filter(F.col("event_time") >= F.lit(cut))

    def run():
        q = user_state.start_user_state(_stream(spark, events, src, 2), out, ckpt, 8, "availableNow", state_partitions=4)
        streams.await_all([q], 300)
        return len([p for p in q.recentProgress if p["numInputRows"]])

    files.write_replay(early, src, "event_time", min_files=4)
    assert run() >= 2
    table = user_state.read_user_state(spark, out)
    assert _same(user_state.latest_ratings(table), state.latest_ratings(early)) and _same(user_state.liked_pairs(table), state.liked_pairs(early))
    before = manifest.read_manifest(spark, out)
    run()  # a restart without news writes nothing
    assert manifest.read_manifest(spark, out).parts == before.parts
    late.repartition(3).write.mode("append").parquet(src)
    run()  # the restarted state goes on from the first half
    table = user_state.read_user_state(spark, out)
    assert _same(user_state.latest_ratings(table), state.latest_ratings(events)) and _same(user_state.liked_pairs(table), state.liked_pairs(events))


def test_upsert_touches_only_the_parts_of_changed_keys(spark):
    path = fresh_path(spark, "upsert")
    frame = lambda data: spark.createDataFrame(data, user_state.STATE_SCHEMA)
    all_keys = [(f"u{i}", m, i % 6, i % 2 == 0) for i in range(40) for m in ("a", None)]
    assert len(user_state.upsert(frame(all_keys), path, "q", 0, 16)) > 8
    first = manifest.read_manifest(spark, path)
    touched = user_state.upsert(frame([("u3", "a", 5, True), ("new", "a", None, True)]), path, "q", 1, 16)
    second = manifest.read_manifest(spark, path)
    assert 1 <= len(touched) <= 2
    assert {p for p in second.parts if second.parts[p] != first.parts.get(p)} == {str(b) for b in touched}
    assert user_state.upsert(frame([("u3", "a", 1, False)]), path, "q", 1, 16) == []  # a repeated batch
    want = {(u, m): (r, x) for u, m, r, x in all_keys} | {("u3", "a"): (5, True), ("new", "a"): (None, True)}
    got = rows(user_state.read_user_state(spark, path))
    assert len(got) == len(want) and {(u, m): (r, x) for u, m, r, x in got} == want
    # A reader that holds the older manifest still sees the older table.
    old = manifest.read_parts(spark, path, user_state.STATE_SCHEMA, first)
    assert sorted(rows(old), key=str) == sorted(all_keys, key=str)


def test_user_state_odd_rows(spark):
    evs = [
        ("u", "rate", "A", "X", AT, 3), ("u", "rate", "A", "X", AT, 5), ("u", "rate", "B", "X", AT, None), ("u", "rate", "C", "X", AT, 0),
        ("u", "like", "B", "X", AT, None), (None, "like", None, "X", None, None), ("u", "play", "D", "X", AT, None), ("u", "RATE", "E", "X", AT, 4),
    ]
    got = {(r.user_id, r.movie_id): (r.rating_value, r.liked) for r in user_state.user_state(events_df(spark, evs)).collect()}
    assert got == {("u", "A"): (5, False), ("u", "C"): (0, False), ("u", "B"): (None, True), (None, None): (None, True)}
    assert user_state.user_state(events_df(spark, evs).limit(0)).count() == 0


# --- manifests ----------------------------------------------------------------------------


def test_of_two_writers_one_wins(spark):
    path = fresh_path(spark, "manifest")
    manifest.commit(spark, path, manifest.Manifest(0, {"a": "data/part=1"}, {}))
    with pytest.raises(manifest.CommitConflict):
        manifest.commit(spark, path, manifest.Manifest(0, {"a": "data/part=2"}, {}))
    assert manifest.read_manifest(spark, path).parts == {"a": "data/part=1"}
    once = []

    def change(now):
        if not once:  # another writer comes in between
            once.append(manifest.commit(spark, path, manifest.Manifest(now.number + 1, now.parts | {"b": "data/part=3"}, {})))
        return now.parts | {"c": "data/part=4"}, now.marks

    assert manifest.update(spark, path, change).parts == {"a": "data/part=1", "b": "data/part=3", "c": "data/part=4"}
    assert not [n for n in os.listdir(local_fs_path(f"{path}/{manifest.FOLDER}")) if n.startswith("_new")]


# --- ranked views of closed windows ---------------------------------------------------------


def _closed(events, df, delay=dt.timedelta(minutes=10)):
    return df.filter(F.col("window_end") <= F.lit(events.agg(F.max("event_time")).first()[0] - delay))


def _ntz(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@pytest.mark.parametrize("view", ["trending", "engagement"])
def test_top_of_closed_windows(spark, events, replay, view):
    build, rank, k = ranked.VIEWS[view]
    out, ckpt = fresh_path(spark, "top"), fresh_path(spark, "ckpt")
    q = ranked.start_top_closed(view, _stream(spark, events, replay), out, ckpt, "5 minutes", trigger="availableNow", state_partitions=4)
    streams.await_all([q], 300)
    want = rank(_closed(events, build(events, "5 minutes")), k)
    got = _ntz(read_latest(spark, out))
    assert got.count() == k and _same(got, want)
    # The state holds open windows only, however many have been closed.
    held = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert held[-1] < 0.2 * build(events, "5 minutes").count()


def test_repeated_batch_of_a_ranked_view(spark, events):
    """A batch whose version was written, but not its mark, is merged again without harm."""
    from cinepulse.sources.versioned import merge_each_batch

    windows, out = windowed.trending_genres(events, "5 minutes"), fresh_path(spark, "top")
    keys = ["window_start", "window_end", "genre"]
    merge = lambda held, b: windowed.top_trending(b, 10) if held is None else windowed.top_trending(held.unionByName(windowed.top_trending(b, 10)).dropDuplicates(keys), 10)
    for epoch in (0, 1, 1):
        part = windows.filter(F.pmod(F.xxhash64("genre"), F.lit(2)) == epoch)
        merge_each_batch(out, merge)(part, epoch)
        if epoch:
            for folder in os.listdir(local_fs_path(out)):
                for name in os.listdir(os.path.join(local_fs_path(out), folder)):
                    if name.endswith("-1"):
                        os.rename(os.path.join(local_fs_path(out), folder, name), os.path.join(local_fs_path(out), folder, "_lost"))
    assert _same(read_latest(spark, out), windowed.top_trending(windows, 10))


def test_top_genre_per_window_stream(spark, events, replay):
    out, ckpt = fresh_path(spark, "topgenre"), fresh_path(spark, "ckpt")
    q = ranked.start_top_per_window(_stream(spark, events, replay), out, ckpt, "6 hours", "10 minutes", "availableNow", state_partitions=4)
    streams.await_all([q], 300)
    want = _closed(events, windowed.top_genre_per_window(windowed.trending_genres(events, "6 hours")))
    assert _same(_ntz(spark.read.parquet(out).drop("dt")), want) and want.count() > 10
    held = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert max(held[-2:]) < 30


# --- one read for three sinks -----------------------------------------------------------------


def _check_sinks(spark, path, events):
    schema = events.schema
    assert _same(fanout.read_trending(spark, path, schema), windowed.trending_genres(events))
    assert _same(fanout.read_engagement(spark, path, schema), windowed.engagement_scores(events))
    assert _same(lake.partition_counts(fanout.read_sink(spark, path, fanout.RAW, schema)), lake.partition_counts(lake.with_partition_columns(events)))


def test_fanout_reads_once_and_compacts(spark, events, replay):
    out, ckpt = fresh_path(spark, "fanout"), fresh_path(spark, "ckpt")
    q = fanout.start_fanout(_stream(spark, events, replay), out, ckpt, trigger="availableNow")
    streams.await_all([q], 300)
    batches = [p for p in q.recentProgress if p["numInputRows"]]
    assert len(batches) > 1 and sum(p["numInputRows"] for p in batches) == events.count()  # not three times
    _check_sinks(spark, out, events)
    pinned = manifest.read_manifest(spark, out)
    assert sorted(fanout.compact(spark, out, events.schema, least_parts=2)) == sorted(fanout.SINKS)
    now = manifest.read_manifest(spark, out)
    assert len(now.parts) == 3 and now.marks == pinned.marks
    _check_sinks(spark, out, events)
    assert fanout.read_sink(spark, out, fanout.RAW, events.schema, pinned).count() == events.count()  # a reader during compaction
    assert fanout.compact(spark, out, events.schema, least_parts=2) == []


def test_failure_between_two_sinks_leaves_no_duplicate(spark, events):
    path = fresh_path(spark, "fanout")
    halves = [events.filter(F.col("event_id") % 2 == i) for i in (0, 1)]
    fanout.write_batch(halves[0], path, "q", 0)

    def fail(sink):
        if sink == fanout.TRENDING:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        fanout.write_batch(halves[1], path, "q", 1, after_sink=fail)
    _check_sinks(spark, path, halves[0])  # nothing of the failed batch is seen
    for _ in range(2):  # the batch again, and once more after its commit
        fanout.write_batch(halves[1], path, "q", 1)
    _check_sinks(spark, path, events)


def test_compaction_leaves_parts_that_came_meanwhile(spark, events, monkeypatch):
    path = fresh_path(spark, "fanout")
    thirds = [events.filter(F.col("event_id") % 3 == i) for i in range(3)]
    for i in (0, 1):
        fanout.write_batch(thirds[i], path, "q", i)
    write = fanout._write

    def late(rows_, sink, at):
        folder = write(rows_, sink, at)
        if sink == fanout.RAW and at == path:
            monkeypatch.setattr(fanout, "_write", write)
            fanout.write_batch(thirds[2], path, "q", 2)
        return folder

    monkeypatch.setattr(fanout, "_write", late)
    assert sorted(fanout.compact(spark, path, events.schema, least_parts=2)) == sorted(fanout.SINKS)
    _check_sinks(spark, path, events)
    assert len([p for p in manifest.read_manifest(spark, path).parts if p.startswith("raw/")]) == 2
