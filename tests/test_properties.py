"""Random event sets: operators against a brute-force model of the same rules."""

from __future__ import annotations

import collections
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cinepulse.operators import live, windowed
from cinepulse.sources.fixtures import events_df

BASE = dt.datetime(2024, 1, 15, 10, 0)
AS_OF = BASE + dt.timedelta(minutes=20)

event = st.tuples(
    st.sampled_from(["u1", "u2", "u3"]),
    st.sampled_from(["play", "like", "rate", "PLAY", None]),
    st.sampled_from(["A", "B", "C", "", None]),
    st.sampled_from(["X", "Y", "", None]),
    st.one_of(st.none(), st.integers(min_value=0, max_value=30 * 60).map(lambda s: BASE + dt.timedelta(seconds=s))),
    st.one_of(st.none(), st.integers(min_value=0, max_value=5)),
)
events = st.lists(event, min_size=0, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _window_start(t: dt.datetime) -> dt.datetime:
    return t.replace(minute=t.minute - t.minute % 5, second=0, microsecond=0)


@SETTINGS
@given(events)
def test_windowed_matches_model(spark, data):
    ev = events_df(spark, data)
    got = {(r.window_start, r.movie_id, r.genre): (r.views, r.likes, r.avg_rating, r.engagement_score) for r in windowed.engagement_scores(ev).collect()}
    acc = collections.defaultdict(lambda: [0, 0, []])
    for _, a, m, g, t, r in data:
        if t is None:
            continue
        e = acc[(_window_start(t), m, g)]
        e[0] += a == "play"
        e[1] += a == "like"
        if a == "rate" and r is not None:
            e[2].append(r)
    want = {}
    for k, (v, l, rs) in acc.items():
        avg = sum(rs) / len(rs) if rs else 0.0
        want[k] = (v, l, avg, v * 1.0 + l * 2.0 + avg * 5.0)
    assert got == want
    trend = {(r.window_start, r.genre): r.activity_count for r in windowed.trending_genres(ev).collect()}
    counts = collections.Counter((_window_start(t), g) for _, _, _, g, t, _ in data if t is not None and g is not None)
    assert trend == dict(counts)
    top = windowed.calculate_engagement_score(ev, k=3).collect()
    assert len(top) == min(3, len(want))
    if top:  # the cut keeps the best scores
        assert min(r.engagement_score for r in top) >= sorted((w[3] for w in want.values()), reverse=True)[len(top) - 1]


@SETTINGS
@given(events)
def test_live_matches_model(spark, data):
    ev = events_df(spark, data)
    cutoff = AS_OF - dt.timedelta(minutes=5)
    recent = [(i, row) for i, row in enumerate(data, start=1) if row[4] is not None and row[4] > cutoff]
    recent.sort(key=lambda x: (x[1][4], x[0]))  # arrival order = (event_time, event_id)
    genres, movies = {}, {}
    for _, (_, a, m, g, _, r) in recent:
        if g:
            genres[g] = genres.get(g, 0) + 1
        if m:
            s = movies.setdefault(m, {"views": 0, "likes": 0, "total": 0, "n": 0, "genre": g})
            s["views"] += a == "play"
            s["likes"] += a == "like"
            if a == "rate" and r:
                s["total"] += r
                s["n"] += 1
    want_genres = sorted(genres.items(), key=lambda x: x[1], reverse=True)[:5]
    got_genres = [(r.genre, r.score) for r in live.live_trending_genres(ev, AS_OF).collect()]
    assert got_genres == want_genres
    scored = []
    for m, s in movies.items():
        avg = s["total"] / s["n"] if s["n"] else 0.0
        scored.append((m, s["genre"], s["views"] + 2 * s["likes"] + 5 * avg))
    scored.sort(key=lambda x: x[2], reverse=True)
    got_movies = [(r.movie_id, r.genre, r.score) for r in live.live_movie_scores(ev, AS_OF).collect()]
    assert got_movies == [(m, g, float(s)) for m, g, s in scored[:10]]


FIELDS = ["user_id", "action", "movie_id", "genre", "timestamp"]
payload = st.fixed_dictionaries(
    {},
    optional={
        **{f: st.one_of(st.none(), st.text(max_size=6)) for f in FIELDS},
        "rating_value": st.one_of(st.none(), st.integers(-5, 10), st.sampled_from([4.5, 2.25])),
    },
)


@SETTINGS
@given(st.lists(payload, min_size=1, max_size=15))
def test_decode_and_validate_match_model(spark, payloads):
    import json

    from pyspark.sql import types as T

    from cinepulse.operators import ingest

    schema = T.StructType([T.StructField("value", T.BinaryType()), T.StructField("timestamp", T.TimestampType())])
    msgs = spark.createDataFrame([(bytearray(json.dumps(p).encode()), BASE) for p in payloads], schema)
    got = [tuple(r[f] for f in [*FIELDS, "rating_value"]) for r in ingest.parse_events(msgs).collect()]

    def model(p):
        r = p.get("rating_value")
        return (*[p.get(f) for f in FIELDS], r if isinstance(r, int) else None)

    assert sorted(got, key=repr) == sorted((model(p) for p in payloads), key=repr)

    def reason(p):
        for f in FIELDS:
            if p.get(f) is None:
                return f"missing_{f}"
        if isinstance(p.get("rating_value"), float):
            return "invalid_rating_value"  # no whole number
        return None

    want = collections.Counter(r for r in map(reason, payloads) if r)
    counts = {row.reason: row.n for row in ingest.quarantine_counts(msgs).collect()}
    assert counts == dict(want)
