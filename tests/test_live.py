"""Live family and catalogue views: golden results and edge rules."""

from __future__ import annotations

import pytest

from cinepulse.operators import catalog as cat
from cinepulse.operators import live
from cinepulse.sources.fixtures import events_df, sample_catalog, sample_events

from helpers import rows, t

AS_OF = t(32)


def test_live_genres_golden(spark):
    got = rows(live.live_trending_genres(sample_events(spark), AS_OF), "genre", "score")
    assert got == [("Sci-Fi", 3), ("Action", 2), ("Thriller", 1), ("Romance", 1), ("Horror", 1)]


def test_live_movies_golden(spark):
    got = rows(live.live_movie_scores(sample_events(spark), AS_OF), "movie_id", "score")
    assert got == [("D", 25.0), ("G", 25.0), ("A", 23.0), ("B", 2.0), ("C", 2.0), ("F", 2.0), ("E", 1.0)]


def test_leaderboard_golden(spark):
    got = rows(cat.leaderboard(sample_events(spark), sample_catalog(spark), AS_OF), "rank", "title", "points")
    assert sorted(got) == [
        (1, "Love in Paris", 25),
        (2, "Ocean Deep", 25),
        (3, "Cosmic Journey", 23),
        (4, "The Last Stand", 2),
        (5, "Midnight Express", 2),
    ]


def test_headline_and_share_golden(spark):
    ev, catalog = sample_events(spark), sample_catalog(spark)
    assert rows(cat.headline_movie(ev, catalog, AS_OF), "title") == [("Love in Paris",)]
    share = sorted(rows(cat.genre_share(ev, AS_OF), "rank", "pct_of_max"))
    assert [round(p, 2) for _, p in share] == [100.0, 66.67, 33.33, 33.33, 33.33]
    # no live movie -> the catalogue's most liked
    empty = ev.filter("false")
    assert rows(cat.headline_movie(empty, catalog, AS_OF), "title") == [("Dragon Quest",)]


def test_trailing_boundary_and_future(spark):
    ev = events_df(
        spark,
        [
            ("u", "play", "A", "X", t(27), None),  # exactly as_of - 5 min: excluded
            ("u", "play", "B", "X", t(27, 1), None),
            ("u", "play", "C", "X", t(40), None),  # future: included
        ],
    )
    got = {m for (m,) in rows(live.live_movie_scores(ev, AS_OF), "movie_id")}
    assert got == {"B", "C"}


def test_live_rating_zero_and_first_genre(spark):
    ev = events_df(
        spark,
        [
            ("u", "rate", "A", "Sci-Fi", t(30), 4),
            ("u", "rate", "A", "Drama", t(31), 0),  # rating 0 ignored, second genre ignored
            ("u", "play", "B", "", t(31), None),  # empty genre: movie kept, genre not counted
            ("u", "PLAY", "C", "Drama", t(31), None),  # unknown action: genre +1, score 0
        ],
    )
    movies = {r[0]: r for r in rows(live.live_movie_scores(ev, AS_OF), "movie_id", "genre", "avg_rating", "score")}
    assert movies["A"] == ("A", "Sci-Fi", 4.0, 20.0)
    assert movies["B"][1] == "" and movies["C"][3] == 0.0
    genres = dict(rows(live.live_trending_genres(ev, AS_OF), "genre", "score"))
    assert genres == {"Sci-Fi": 1, "Drama": 2}


def test_leaderboard_unknown_movie_dropped_after_cut(spark):
    ev = events_df(spark, [("u", "like", m, "X", t(30), None) for m in ["A", "ZZ", "B"]])
    got = rows(cat.leaderboard(ev, sample_catalog(spark), AS_OF, shown=2), "rank", "movie_id")
    assert sorted(got) == [(1, "A")]  # ZZ took rank 2 and is not in the catalogue


def test_snapshot_and_health(spark):
    ev = sample_events(spark)
    snap = rows(live.trending_snapshot(ev, AS_OF), "section", "position", "key")
    assert ("trending_genres", 1, "Sci-Fi") in snap and ("movie_scores", 1, "D") in snap
    assert len(snap) == 5 + 7
    nested = live.trending_snapshot_nested(ev, AS_OF).collect()
    assert len(nested) == 1
    assert [g["genre"] for g in nested[0]["trending_genres"]] == ["Sci-Fi", "Action", "Thriller", "Romance", "Horror"]
    assert [m["movie_id"] for m in nested[0]["movie_scores"]][:3] == ["D", "G", "A"]
    assert rows(live.health_counts(ev, t(40)), "events_processed", "events_in_window") == [(10, 0)]
    assert rows(live.health_counts(ev, AS_OF), "events_processed", "events_in_window") == [(10, 10)]


def test_default_as_of_is_max_time(spark):
    ev = sample_events(spark)
    assert rows(live.live_trending_genres(ev), "genre")[0] == ("Sci-Fi",)


@pytest.mark.parametrize("genre,n", [("All", 8), ("Sci-Fi", 1), ("Nope", 0)])
def test_catalog_by_genre(spark, genre, n):
    assert cat.by_genre(sample_catalog(spark), genre).count() == n


def test_catalog_stats_golden(spark):
    c = sample_catalog(spark)
    assert rows(cat.totals(c)) == [(11270, 117500)]
    assert rows(cat.counts(c)) == [(8, 8)]
    ext = cat.extremes(c).first()
    assert (ext.most_liked_title, ext.most_viewed_title, ext.highest_rated_title) == ("Dragon Quest", "Dragon Quest", "Ocean Deep")


def test_catalog_argmax_tie_last_wins(spark):
    from cinepulse import schema as S

    c = spark.createDataFrame(
        [(0, "A", "a", "X", 1, 2024, 4.0, 10, 5), (1, "B", "b", "X", 1, 2024, 4.0, 10, 5)], S.CATALOG_SCHEMA
    )
    ext = cat.extremes(c).first()
    assert (ext.most_liked_id, ext.most_viewed_id, ext.highest_rated_id) == ("B", "B", "B")


def test_genre_list(spark):
    got = sorted(g for (g,) in rows(cat.genre_list(sample_catalog(spark))))
    assert got == sorted(["All", "Sci-Fi", "Action", "Thriller", "Romance", "Horror", "Comedy", "Documentary", "Fantasy"])


def test_snapshot_table_overwrite(spark):
    from cinepulse.session import fresh_path
    from cinepulse.sources import snapshot

    path = fresh_path(spark, "snapshot")
    ev = sample_events(spark)
    snapshot.publish_live_snapshot(ev, path, AS_OF)
    snapshot.publish_live_snapshot(ev, path, t(30))  # a second refresh replaces the first
    assert snapshot.read_snapshot(spark, path).count() == 12
    assert rows(snapshot.read_snapshot(spark, path, "trending_genres").orderBy("position"), "key")[0] == ("Sci-Fi",)
    for v in range(1, 6):  # explicit versions; only the newest three are kept
        snapshot.write_snapshot(live.trending_snapshot(ev, AS_OF).limit(v), path, version=v, keep=3)
    import os

    from cinepulse.session import local_fs_path

    kept = sorted(d for d in os.listdir(local_fs_path(path)) if d.startswith("version="))
    assert len(kept) == 3
    assert snapshot.read_snapshot(spark, path).count() == 12  # the epoch-ms versions are newer


def test_nested_snapshot_table(spark):
    from cinepulse.session import fresh_path
    from cinepulse.sources import snapshot

    path = fresh_path(spark, "snapshot-nested")
    snapshot.publish_live_snapshot(sample_events(spark), path, AS_OF, nested=True)
    (row,) = snapshot.read_snapshot(spark, path).collect()
    assert [g["genre"] for g in row["trending_genres"]] == ["Sci-Fi", "Action", "Thriller", "Romance", "Horror"]
    top = row["movie_scores"][0]
    assert (top["movie_id"], top["genre"], top["score"], top["views"], top["likes"], top["avg_rating"]) == ("D", "Romance", 25.0, 0, 0, 5.0)
