"""The indexed live view equals the view from the events, with bounded reads."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cinepulse.operators import live, time_index
from cinepulse.session import fresh_path
from cinepulse.sources.adapter import activity
from cinepulse.sources.fixtures import events_df

from helpers import plan, rows

US = dt.timedelta(microseconds=1)


def test_cover_is_exact_and_short():
    rng = random.Random(1)
    sizes = {time_index.RAW: US, "1 minute": dt.timedelta(minutes=1), "1 hour": dt.timedelta(hours=1), "1 day": dt.timedelta(days=1)}
    base = dt.datetime(2024, 1, 15)
    cases = [(base, base), (base, base + US), (base - US, base + dt.timedelta(days=2)), (base, base + dt.timedelta(days=1))]
    cases += [(a := base + rng.randrange(10**11) * US, a + rng.randrange(10 ** rng.randrange(1, 13)) * US) for _ in range(300)]
    for low, high in cases:
        ranges = sorted(time_index.cover(low, high), key=lambda r: r[1])
        assert ([ranges[0][1], ranges[-1][2]] == [low, high]) if low < high else not ranges
        assert all(a[2] == b[1] for a, b in zip(ranges, ranges[1:]))  # disjoint, without gaps
        for level, a, b in ranges:
            unit = sizes[level]
            assert level == time_index.RAW or ((a - base) % unit, (b - base) % unit) == (dt.timedelta(0),) * 2
            assert (b - a) < {time_index.RAW: 2 * sizes["1 minute"], "1 minute": 2 * sizes["1 hour"], "1 hour": 2 * sizes["1 day"]}.get(level, dt.timedelta.max)


def _stamp(t):
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _brute(events, as_of, window):
    inside = events.filter((F.col("event_time") > _stamp(as_of - window)) & (F.col("event_time") <= _stamp(as_of)))
    far = "50000 days"  # the trailing predicate holds for all rows that are left
    genres = [(r.genre, r.score) for r in live.live_trending_genres(inside, as_of, far).collect()]
    movies = [tuple(r) for r in live.live_movie_scores(inside, as_of, far).collect()]
    return genres, movies


def _indexed(spark, path, instants):
    genres = time_index.live_genres_at(spark, path, instants).orderBy("as_of", "position").collect()
    movies = time_index.live_movies_at(spark, path, instants).orderBy("as_of", "position").collect()
    return {
        t: ([(r.genre, r.score) for r in genres if r.as_of == t], [tuple(r)[2:] for r in movies if r.as_of == t]) for t, _ in instants
    }


def test_twenty_random_instants(spark, sf_small):
    ev = activity(spark, sf_small).cache()
    path = time_index.write_index(ev, fresh_path(spark, "index"))
    first, last = ev.agg(F.min("event_time"), F.max("event_time")).first()
    rng = random.Random(7)
    instants = [(last, dt.timedelta(days=400)), (first - US, dt.timedelta(days=1))]
    instants += [(first + rng.random() * (last - first), rng.choice([60, 3600, 86400]) * rng.uniform(0.01, 9) * dt.timedelta(seconds=1)) for _ in range(18)]
    got = _indexed(spark, path, instants)
    assert sum(bool(g) for g, _ in got.values()) > 10
    for as_of, window in instants:
        assert got[as_of] == _brute(ev, as_of, window), (as_of, window)


def test_equals_the_live_view_at_the_newest_event(spark, sf_small):
    ev = activity(spark, sf_small)
    path = time_index.write_index(ev, fresh_path(spark, "index"))
    last = ev.agg(F.max("event_time")).first()[0]
    for window in ("5 minutes", "3 days"):
        got = _indexed(spark, path, [(last, window)])[last]
        assert got[0] == [tuple(r) for r in live.live_trending_genres(ev, last, window).collect()]
        assert got[1] == [tuple(r) for r in live.live_movie_scores(ev, last, window).collect()]


def test_edges_ties_and_odd_rows(spark):
    """Events on bucket edges, equal times, NULL and empty keys, rating 0, no time."""
    at = dt.datetime(2024, 1, 15)
    evs = [
        ("u", "play", "A", "X", at, None), ("u", "like", "A", "Y", at, None), ("u", "rate", "B", "", at + US, 0),
        ("u", "rate", "B", None, at + dt.timedelta(minutes=1), 4), ("u", "play", "", "X", at + dt.timedelta(hours=1), None),
        ("u", "play", None, "Z", at + dt.timedelta(days=1), None), ("u", "odd", "C", "Z", at + dt.timedelta(days=1) + US, None),
        ("u", "play", "D", "Z", None, None),
    ]
    ev = events_df(spark, evs).cache()
    path = time_index.write_index(ev, fresh_path(spark, "index"))
    instants = [(at + d + e * US, w) for d in (dt.timedelta(0), dt.timedelta(minutes=1), dt.timedelta(days=1)) for e in (-1, 0, 1) for w in (dt.timedelta(minutes=1), )]
    instants += [(at + dt.timedelta(days=2), dt.timedelta(days=2) + i * US) for i in (0,)] + [(at + dt.timedelta(days=1, microseconds=5), dt.timedelta(days=1, microseconds=5))]
    got = _indexed(spark, path, instants)
    for as_of, window in instants:
        assert got[as_of] == _brute(ev, as_of, window), (as_of, window)


def test_a_day_is_replaced_alone(spark, sf_small):
    ev = activity(spark, sf_small).cache()
    path = time_index.write_index(ev, fresh_path(spark, "index"))
    day = ev.filter(F.to_date(F.col("event_time") - F.expr("INTERVAL 1 MICROSECOND")) == "2024-01-10")
    time_index.write_index(day, path)  # repeated load of a day
    last = ev.agg(F.max("event_time")).first()[0]
    instants = [(last, dt.timedelta(days=60)), (dt.datetime(2024, 1, 10, 13, 1, 2, 3), dt.timedelta(hours=30))]
    got = _indexed(spark, path, instants)
    assert all(got[t] == _brute(ev, t, w) for t, w in instants)


def test_reads_are_bounded(spark, sf_small):
    path = time_index.write_index(activity(spark, sf_small), fresh_path(spark, "index"))
    instant = (dt.datetime(2024, 1, 20, 13, 1, 2, 3), dt.timedelta(days=12, hours=3, minutes=5, seconds=6))
    text = plan(time_index.partials_at(spark, path, "genres", [instant]))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 4 and all("PartitionFilters: [" in s and "dt#" in s.split("PartitionFilters: [")[1][:60] for s in scans)
    raw = next(s for s in scans if "event_time" in s.split("ReadSchema")[1])
    assert "GreaterThan(event" in raw and "LessThanOrEqual(event" in raw  # the plan's text cuts names short
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    read = {}
    for level, low, high in time_index.cover(instant[0] - instant[1], instant[0]):
        read[level] = read.get(level, 0) + (0 if level == time_index.RAW else (high - low) // time_index.to_timedelta(level))
    assert read["1 minute"] <= 2 * 59 and read["1 hour"] <= 2 * 23 and read["1 day"] <= 12


def test_levels_must_nest(spark, sf_small):
    with pytest.raises(ValueError):
        time_index.cover(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), ("7 minutes", "1 hour"))


def test_no_instants_and_no_events(spark, sf_small):
    ev = activity(spark, sf_small)
    path = time_index.write_index(ev, fresh_path(spark, "index"))
    assert rows(time_index.live_genres_at(spark, path, [])) == []
    assert rows(time_index.live_movies_at(spark, path, [(dt.datetime(1999, 1, 1), "1 day")])) == []
    empty = time_index.write_index(ev.limit(0), fresh_path(spark, "index"))
    assert rows(time_index.live_genres_at(spark, empty, [(dt.datetime(2024, 1, 10), "1 day")])) == []
