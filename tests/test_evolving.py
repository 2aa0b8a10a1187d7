"""Reports by changed days, a catalogue with versions, and the audit of streamed state."""

from __future__ import annotations

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from cinepulse.operators import catalog_history, day_partials, reports
from cinepulse.session import fresh_path, local_fs_path
from cinepulse.sources import files, lake, manifest
from cinepulse.sources.adapter import activity
from cinepulse.streaming import audit, catalog_stream, user_state
from cinepulse.streaming import queries as streams

from helpers import plan, rows


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def events(spark, sf_small):
    """Events with a time that has a zone, as a lake gives them back, and a few without one."""
    ev = activity(spark, sf_small).withColumn("event_time", F.col("event_time").cast("timestamp"))
    timeless = ev.limit(3).withColumn("event_time", F.lit(None).cast("timestamp"))
    path = fresh_path(spark, "events")
    ev.unionByName(timeless).write.parquet(path)
    return spark.read.parquet(path)


# --- reports by changed days --------------------------------------------------------------


def _check(spark, lake_path, out, schema):
    now = lake.read_lake(spark, lake_path, schema=schema)
    assert _same(day_partials.daily_report(spark, out), reports.daily_report(now))
    assert _same(day_partials.monthly_report(spark, out), reports.monthly_report(now))


def test_only_days_with_changed_files_are_recomputed(spark, events):
    path, out, schema = fresh_path(spark, "lake"), fresh_path(spark, "partials"), lake.stored_schema(events)
    lake.write_lake(events, path)
    first = day_partials.refresh(spark, path, out, schema)
    days = {str(r[0]) for r in events.filter("event_time is not null").select(F.to_date("event_time")).distinct().collect()}
    assert set(first.recomputed) == days | {day_partials.NULL_DAY} and not first.dropped
    _check(spark, path, out, schema)

    assert day_partials.refresh(spark, path, out, schema) == day_partials.Refresh([], [])
    before = manifest.read_manifest(spark, out)

    late = events.filter(F.to_date("event_time").isin(dt.date(2024, 1, 5), dt.date(2024, 1, 9)))
    lake.write_lake(late, path)  # two late files, rows repeated
    assert day_partials.refresh(spark, path, out, schema).recomputed == ["2024-01-05", "2024-01-09"]
    after = manifest.read_manifest(spark, out)
    assert {d for d in after.parts if after.parts[d] != before.parts[d]} == {"2024-01-05", "2024-01-09"}
    _check(spark, path, out, schema)

    lake.write_lake(events.filter("event_time is null"), path)
    assert day_partials.refresh(spark, path, out, schema).recomputed == [day_partials.NULL_DAY]
    _check(spark, path, out, schema)

    shutil.rmtree(f"{local_fs_path(path)}/dt=2024-01-09")
    assert day_partials.refresh(spark, path, out, schema) == day_partials.Refresh([], ["2024-01-09"])
    _check(spark, path, out, schema)


def test_rewritten_day_is_found_and_one_month_is_pruned(spark, events):
    path, out, schema = fresh_path(spark, "lake"), fresh_path(spark, "partials"), lake.stored_schema(events)
    timed = events.filter("event_time is not null")
    # a second month
    both = timed.unionByName(timed.withColumn("event_time", F.col("event_time") + F.expr("interval 40 days")))
    lake.write_lake(both, path)
    day_partials.refresh(spark, path, out, schema)
    _check(spark, path, out, schema)
    february = day_partials.monthly_report(spark, out, "2024-02")
    want = reports.monthly_report(both).filter("month = date'2024-02-01'")
    assert want.count() and _same(february, want)
    day = timed.filter(F.to_date("event_time") == "2024-01-07")
    lake.write_lake(day.withColumn("movie_id", F.lit("m")), path, replace_partitions=True)
    assert day_partials.refresh(spark, path, out, schema).recomputed == ["2024-01-07"]
    _check(spark, path, out, schema)


def test_signatures_open_no_file_and_an_empty_lake_has_no_day(spark, events):
    path, out, schema = fresh_path(spark, "lake"), fresh_path(spark, "partials"), lake.stored_schema(events)
    lake.write_lake(events.limit(0), path)
    assert day_partials.refresh(spark, path, out, schema) == day_partials.Refresh([], [])
    assert day_partials.daily_report(spark, out).count() == 0
    assert day_partials.monthly_report(spark, out).count() == 0
    lake.write_lake(events, path)
    assert "content" not in plan(day_partials.day_signatures(spark, path))


# --- a catalogue with versions ---------------------------------------------------------------


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def _log(spark, *changes):
    return spark.createDataFrame(list(changes), catalog_history.CHANGE_SCHEMA)


LOG = [
    (1, "a", _at(2), "a one", "x", False),
    (2, "a", _at(5), "a lost", "x", False),
    (3, "a", _at(5), "a two", "y", False),  # same instant: the larger id
    (4, "a", _at(8), None, None, True),
    (5, "a", _at(10), "a again", "x", None),
    (6, "b", _at(3), "b one", None, False),
    (7, None, _at(1), "nobody", "x", False),
    (8, "b", None, "never", "x", False),
]


@pytest.mark.parametrize("most", [0, 1 << 40])
def test_events_join_the_version_valid_at_their_time(spark, most):
    ev = spark.createDataFrame(
        [
            (1, "a", _at(1), "own"), (2, "a", _at(2), "own"), (3, "a", _at(4, 23), "own"), (4, "a", _at(5), "own"), (5, "a", _at(8), "own"),
            (6, "a", _at(9), "own"), (7, "a", _at(20), "own"), (8, "b", _at(4), "own"), (9, "c", _at(4), "own"), (10, None, _at(4), "own"),
            (11, "a", None, "own"), (2, "a", _at(2), "own"),
        ],
        "event_id long, movie_id string, event_time timestamp, title string",  # a title of its own: replaced
    )
    out = catalog_history.join_versions(ev, catalog_history.history(_log(spark, *LOG)), max_broadcast_bytes=most, salt_buckets=4)
    assert out.columns == ["event_id", "movie_id", "event_time", "change_id", "title", "catalog_genre", "valid_from", "valid_to"]
    got = sorted(rows(out, "event_id", "title", "valid_from", "valid_to"), key=str)
    none = (None, None, None)
    one, two = ("a one", _at(2), _at(5)), ("a two", _at(5), _at(8))
    want = [(1, *none), (2, *one), (2, *one), (3, *one), (4, *two), (5, *none), (6, *none), (7, "a again", _at(10), None)]
    want += [(8, "b one", _at(3), None), (9, *none), (10, *none), (11, *none)]
    assert got == sorted(want, key=str)


def test_both_joins_agree_on_a_hot_movie(spark, events):
    hot = events.withColumn("movie_id", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("movie_id")))
    ids = spark.range(300).select(
        F.col("id").alias("change_id"), F.when(F.col("id") < 299, "hot").otherwise("other").alias("movie_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=(F.col("id") * 2).cast("int"))).alias("changed_at"),
        F.col("id").cast("string").alias("title"), F.lit("g").alias("catalog_genre"), (F.col("id") % 7 == 0).alias("deleted"),
    )
    versions = catalog_history.history(ids)
    a = catalog_history.join_versions(hot, versions)
    b = catalog_history.join_versions(hot, versions, max_broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan(a) and "Join" not in plan(b)
    assert a.count() == hot.count() and a.filter("title is not null").count() > 0 and _same(a, b)
    empty = catalog_history.history(_log(spark))
    for most in (0, 1 << 40):
        assert catalog_history.join_versions(hot, empty, max_broadcast_bytes=most).filter("title is null").count() == hot.count()
        assert catalog_history.join_versions(hot.limit(0), versions, max_broadcast_bytes=most).count() == 0


def test_only_versions_of_hot_movies_are_copied(spark):
    ev = spark.range(400).select(
        F.col("id").alias("event_id"), F.when(F.col("id") < 300, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 20)).alias("movie_id"),
        (F.lit("2024-01-10").cast("timestamp") + F.make_dt_interval(hours=(F.col("id") % 100).cast("int"))).alias("event_time"),
    )
    ids = spark.range(2000).select(
        F.col("id").alias("change_id"), F.when(F.col("id") % 100 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 100)).alias("movie_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=(F.col("id") / 100).cast("int"))).alias("changed_at"),
        F.col("id").cast("string").alias("title"), F.lit("g").alias("catalog_genre"), (F.col("id") % 700 == 0).alias("deleted"),
    )
    versions = catalog_history.history(ids)
    want = catalog_history.join_versions(ev, versions)
    for hot_rows, salted in ((300, False), (50, True), (1, True)):
        got = catalog_history.join_versions(ev, versions, max_broadcast_bytes=0, hot_rows=hot_rows)
        assert ("explode" in plan(got)) is salted and got.count() == 400 and _same(want, got)
    first, last, hot = catalog_history._spread(ev, "event_time", 4, 50)
    assert (last - first, rows(hot)) == (99 * 3600 * 10**6, [("hot", 4)])


@pytest.mark.parametrize("most", [0, 1 << 40])
def test_changes_of_the_movies_that_events_name(spark, most):
    ev = spark.createDataFrame([(1, "b", _at(4)), (2, None, _at(4)), (3, "c", _at(4)), (4, "b", None)], "event_id long, movie_id string, event_time timestamp")
    log = _log(spark, *LOG)
    few = catalog_history.changes_of(log, ev)
    assert few.columns == log.columns and sorted(rows(few, "change_id")) == [(6,), (8,)]
    assert _same(catalog_history.changes_of(log, ev, max_movies=1), log) and catalog_history.changes_of(log, ev.limit(0)).count() == 0
    a, b = (catalog_history.join_versions(ev, catalog_history.history(x), max_broadcast_bytes=most) for x in (log, few))
    assert _same(a, b) and a.filter("title is not null").count() == 1


def test_stream_sees_changes_published_while_it_runs(spark):
    src, log, out, ckpt = (fresh_path(spark, x) for x in ("src", "log", "versioned", "ckpt"))
    schema = "event_id long, movie_id string, event_time timestamp"

    def feed(*events):
        spark.createDataFrame(list(events), schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        streams.await_all([catalog_stream.start_versioned(stream, log, out, ckpt, "availableNow")], 300)
        return sorted(rows(catalog_stream.read_versioned(spark, out, stream.schema), "event_id", "title", "catalog_number"))

    assert feed((1, "a", _at(6))) == [(1, None, -1)]  # nothing published yet
    number = catalog_stream.publish_changes(_log(spark, *LOG[:3]), log, "load", 0)
    assert catalog_stream.publish_changes(_log(spark, *LOG[:3]), log, "load", 0) == number  # repeated: not added again
    assert catalog_stream.read_history(spark, log).count() == 2
    assert feed((2, "a", _at(6)))[1:] == [(2, "a two", number)]
    later = catalog_stream.publish_changes(_log(spark, (9, "a", _at(6), "a new", "z", False)), log, "load", 1)
    got = feed((3, "a", _at(6)), (4, "a", _at(3)))
    # rows joined before keep what was known then
    assert got == [(1, None, -1), (2, "a two", number), (3, "a new", later), (4, "a one", later)]


# --- the audit -----------------------------------------------------------------------------------


def test_compare_names_every_kind_of_difference(spark):
    schema = "k string, v int"
    found = spark.createDataFrame([("same", 1), (None, 2), ("off", 3), ("extra", 4), ("twice", 5), ("twice", 5), ("null", None)], schema)
    expected = spark.createDataFrame([("same", 1), (None, 2), ("off", 9), ("lost", 6), ("twice", 5), ("null", None)], schema)
    out = audit.compare(found, expected, ["k"], ["v"])
    assert sorted(rows(out.select("k", "problem", F.col("found.v").alias("f"), F.col("expected.v").alias("e")))) == [
        ("extra", "unexpected", 4, None), ("lost", "missing", None, 6), ("off", "different", 3, 9), ("twice", "repeated", 5, 5),
    ]
    assert audit.compare(found.limit(0), expected.limit(0), ["k"], ["v"]).count() == 0


def test_audit_of_the_checkpointed_user_state(spark, events):
    timed = events.filter("event_time is not null")
    src, out, ckpt = (fresh_path(spark, x) for x in ("src", "state", "ckpt"))
    n = files.write_replay(timed, src, "event_time", rows_per_file=200, min_files=3)
    stream = spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", str(-(-n // 3))).parquet(src)
    query = user_state.start_user_state(stream, out, ckpt, 4, "availableNow", state_partitions=3)
    streams.await_all([query], 300)
    assert audit.streamed_user_state(spark, ckpt).count() == user_state.user_state(timed).count() > 0
    assert audit.audit_user_state(spark, ckpt, timed).count() == 0
    assert audit.audit_user_table(user_state.read_user_state(spark, out), timed).count() == 0
    # an earlier batch held less than all events
    early = audit.audit_user_state(spark, ckpt, timed, batch_id=0)
    assert {r["problem"] for r in early.collect()} >= {"missing"}
    # a planted rating later than all others
    last = timed.filter("action = 'rate' and rating_value is not null").orderBy(F.desc("event_time"), F.desc("event_id")).first()
    other = (last["rating_value"] + 1) % 6
    planted = timed.withColumn("rating_value", F.when(F.col("event_id") == last["event_id"], F.lit(other)).otherwise(F.col("rating_value")))
    (row,) = audit.audit_user_state(spark, ckpt, planted).collect()
    assert (row["user_id"], row["movie_id"], row["problem"]) == (last["user_id"], last["movie_id"], "different")
    assert (row["found"]["rating_value"], row["expected"]["rating_value"]) == (last["rating_value"], other)
