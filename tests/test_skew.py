"""One movie holding a third of all events: results stay exact, work stays spread."""

from __future__ import annotations

import collections
import datetime as dt

from pyspark.sql import functions as F

from cinepulse.functions.joins import lookup_join
from cinepulse.operators import live, state, windowed
from cinepulse.sources.fixtures import events_df

from helpers import plan

BASE = dt.datetime(2024, 1, 15, 10, 0)
N = 3000


def _rows():
    out = []
    for i in range(N):
        movie = "HOT" if i % 3 == 0 else f"m{i % 97}"
        action = ["play", "like", "rate", "pause"][i % 4]
        rating = (i % 6) if action == "rate" else None
        user = "u0" if i % 3 == 0 else f"u{i % 41}"
        out.append((user, action, movie, f"g{i % 7}", BASE + dt.timedelta(seconds=7 * i), rating))
    return out


def test_hot_key_aggregates_exact(spark):
    data = _rows()
    ev = events_df(spark, data).repartition(8)
    got = {
        (r.window_start, r.movie_id, r.genre): (r.views, r.likes, r.avg_rating)
        for r in windowed.engagement_scores(ev).collect()
    }
    want = collections.defaultdict(lambda: [0, 0, []])
    for u, a, m, g, t, r in data:
        start = t.replace(minute=t.minute - t.minute % 5, second=0)
        acc = want[(start, m, g)]
        acc[0] += a == "play"
        acc[1] += a == "like"
        if a == "rate" and r is not None:
            acc[2].append(r)
    want = {k: (v[0], v[1], sum(v[2]) / len(v[2]) if v[2] else 0.0) for k, v in want.items()}
    assert got == want
    p = plan(windowed.engagement_scores(ev))
    assert p.index("partial_count") > p.index("Exchange hashpartitioning")  # partial agg below the shuffle


def test_hot_key_live_and_state(spark):
    data = _rows()
    ev = events_df(spark, data).repartition(8)
    top = live.live_movie_scores(ev, BASE + dt.timedelta(hours=12), "1 day", k=1).first()
    hot = [r for r in data if r[2] == "HOT"]
    assert top.movie_id == "HOT" and top.views == sum(a == "play" for _, a, *_ in hot)
    p = plan(live.live_movie_scores(ev, BASE + dt.timedelta(hours=12), "1 day"))
    assert "partial_count" in p and "partial_min_by" in p
    last = {}
    for u, a, m, g, t, r in data:
        if a == "rate" and r is not None:
            last[(u, m)] = r  # rows are in time order
    got = {(r.user_id, r.movie_id): r.rating_value for r in state.latest_ratings(ev).collect()}
    assert got == last


def test_salted_join_spreads_hot_key(spark):
    ev = events_df(spark, _rows()).repartition(8)
    dim = spark.createDataFrame([("HOT", "x")] + [(f"m{i}", "y") for i in range(97)], "movie_id string, attr string")
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        joined = lookup_join(ev, dim, "movie_id", max_broadcast_bytes=0, salt_buckets=8, salt_cols=["event_id"])
        assert "hashpartitioning(movie_id" in plan(joined) and "_salt" in plan(joined)
        per_task = (
            joined.filter(F.col("movie_id") == "HOT")
            .groupBy(F.spark_partition_id().alias("p"))
            .count()
            .collect()
        )
        assert len(per_task) >= 4  # the hot key is handled by several reducers
        assert sum(r["count"] for r in per_task) == N // 3
        assert joined.count() == N
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
