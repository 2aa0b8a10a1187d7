"""Physical-plan properties: checked broadcast, salted fallback, pushdown, pruning."""

from __future__ import annotations

from cinepulse.functions.joins import estimated_size_bytes, fits_broadcast
from cinepulse.operators import catalog as cat
from cinepulse.operators import windowed
from cinepulse.sources import adapter

from helpers import plan, rows


def test_dimension_broadcast_only_when_small(spark, sf_small):
    part = adapter.table(spark, sf_small, "part").select("p_partkey", "p_type")
    assert estimated_size_bytes(part) is not None
    assert fits_broadcast(part)
    assert not fits_broadcast(part, max_bytes=1)
    p = plan(adapter.activity(spark, sf_small))
    assert "BroadcastHashJoin" in p


def test_salted_join_same_rows(spark, sf_small):
    events, part = adapter.table(spark, sf_small, "events"), adapter.table(spark, sf_small, "part")
    salted = adapter.activity_from(events, part, max_broadcast_bytes=0)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:  # Spark's own size check would broadcast this small side anyway
            spark.conf.set(k, "-1")
        p = plan(salted)
        assert "_salt" in p and "BroadcastExchange" not in p and "SortMergeJoin" in p
        salted_rows = salted.collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    broadcast = adapter.activity_from(events, part)
    assert sorted(salted_rows, key=str) == sorted(broadcast.collect(), key=str)
    assert salted.exceptAll(broadcast).count() == 0 and broadcast.exceptAll(salted).count() == 0
    assert salted.count() == broadcast.count()


def test_filter_and_columns_reach_the_scan(spark, sf_small):
    p = plan(cat.by_genre(adapter.catalog(spark, sf_small), "SMALL"))
    assert "PushedFilters: [IsNotNull(p_type), EqualTo(p_type,SMALL)]" in p
    eng = plan(windowed.engagement_scores(adapter.activity(spark, sf_small)))
    read_schema = eng.split("ReadSchema: ")[1].split("\n")[0]
    assert "user_id" not in read_schema  # column pruning


def test_leaderboard_broadcasts_the_cut_side(spark, sf_small):
    df = cat.leaderboard(adapter.activity(spark, sf_small), adapter.catalog(spark, sf_small), window="1 day")
    p = plan(df)
    # top 10 by TakeOrderedAndProject, numbered in one small aggregate, cut to 5 and
    # broadcast as the build side; no unpartitioned window
    assert "BuildLeft" in p and "TakeOrderedAndProject(limit=10" in p and "posexplode" in p
    assert "WindowExec" not in p and "Window [" not in p
    assert len(rows(df)) <= 5


def test_literal_as_of_reaches_parquet(spark, sf_small):
    from cinepulse.functions.clock import resolve_as_of
    from cinepulse.operators import live

    ev = adapter.activity(spark, sf_small)
    as_of = resolve_as_of(ev)
    p = plan(live.live_movie_scores(ev, as_of, "1 day"))
    assert "GreaterThan(ts," in p.split("PushedFilters: ")[1].split("]")[0] or "GreaterThan(ts," in p
