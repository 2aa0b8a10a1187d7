"""Windowed family: golden results on the sample events and the edge rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cinepulse.operators import windowed
from cinepulse.sources.fixtures import events_df, sample_events

from helpers import plan, rows, t

WIN_START = dt.datetime(2024, 1, 15, 10, 30)
WIN_END = dt.datetime(2024, 1, 15, 10, 35)


def test_trend_golden(spark):
    got = rows(windowed.trending_genres(sample_events(spark)), "window_start", "window_end", "genre", "activity_count")
    expected = {("Sci-Fi", 3), ("Action", 2)} | {(g, 1) for g in ["Comedy", "Documentary", "Horror", "Romance", "Thriller"]}
    assert {(g, n) for _, _, g, n in got} == expected
    assert {(s, e) for s, e, _, _ in got} == {(WIN_START, WIN_END)}


def test_engagement_golden(spark):
    got = rows(
        windowed.calculate_engagement_score(sample_events(spark)),
        "movie_id", "genre", "views", "likes", "avg_rating", "engagement_score",
    )
    assert got == [
        ("D", "Romance", 0, 0, 5.0, 25.0),
        ("G", "Documentary", 0, 0, 5.0, 25.0),
        ("A", "Sci-Fi", 1, 1, 4.0, 23.0),
        ("B", "Action", 2, 0, 0.0, 2.0),
        ("C", "Thriller", 0, 1, 0.0, 2.0),
        ("F", "Comedy", 0, 1, 0.0, 2.0),
        ("E", "Horror", 1, 0, 0.0, 1.0),
    ]


def test_edge_rules(spark):
    ev = events_df(
        spark,
        [
            ("u1", "play", "M", None, t(30), None),  # null genre: own engagement group, not in trend
            ("u1", "play", "M", "", t(31), None),  # empty genre: counted in trend
            ("u1", "rate", "R", "Drama", t(31), 4),
            ("u2", "rate", "R", "Drama", t(32), 0),  # rating 0 is averaged
            ("u3", "PLAY", "R", "Drama", t(32), None),  # unknown action: trend +1, score 0
            ("u3", "pause", "R", "Drama", t(33), None),
            ("u4", "play", "N", "Drama", None, None),  # null time: dropped
            (None, None, None, None, t(34), None),  # malformed row
        ],
    )
    trend = {(g, n) for g, n in rows(windowed.trending_genres(ev), "genre", "activity_count")}
    assert trend == {("", 1), ("Drama", 4)}
    eng = {r[:5] for r in rows(windowed.engagement_scores(ev), "movie_id", "genre", "views", "likes", "avg_rating")}
    assert ("R", "Drama", 0, 0, 2.0) in eng
    assert ("M", None, 1, 0, 0.0) in eng and ("M", "", 1, 0, 0.0) in eng
    assert (None, None, 0, 0, 0.0) in eng
    assert not any(m == "N" for m, *_ in eng)


def test_window_boundaries(spark):
    ev = events_df(spark, [("u", "play", "A", "X", t(30), None), ("u", "play", "A", "X", t(35), None)])
    got = sorted(rows(windowed.trending_genres(ev), "window_start", "window_end"))
    assert got == [(t(30), t(35)), (t(35), t(40))]


def test_ties_total_order(spark):
    ev = events_df(spark, [("u", "like", m, "X", t(30), None) for m in ["C", "A", "B"]])
    top = rows(windowed.calculate_engagement_score(ev, k=2), "movie_id")
    assert top == [("A",), ("B",)]


def test_top_genre_per_window(spark):
    ev = events_df(
        spark,
        [("u", "play", "A", g, t(m, hour=h), None) for h, m, g in [(1, 0, "B"), (2, 0, "A"), (3, 0, "B"), (4, 0, "A"), (5, 0, "C")]],
    )
    got = rows(windowed.top_genre_per_window(windowed.trending_genres(ev, "1 day")), "genre", "activity_count")
    assert got == [("A", 2)]


def test_trend_sum_property(spark, sf_small):
    from cinepulse.sources.adapter import activity

    ev = activity(spark, sf_small)
    total = windowed.trending_genres(ev).agg(F.sum("activity_count")).first()[0]
    assert total == ev.filter(F.col("genre").isNotNull() & F.col("event_time").isNotNull()).count()
    eng = windowed.engagement_scores(ev)
    assert eng.filter(F.col("engagement_score") < 0).count() == 0


def test_topk_is_take_ordered(spark):
    p = plan(windowed.calculate_engagement_score(sample_events(spark)))
    assert "TakeOrderedAndProject" in p
