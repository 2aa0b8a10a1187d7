"""Lake write/read with partition pruning, reports and per-user state."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from cinepulse.operators import reports, state
from cinepulse.session import fresh_path, local_fs_path
from cinepulse.sources import lake
from cinepulse.sources.adapter import activity
from cinepulse.sources.fixtures import events_df

from helpers import plan, rows, t


def test_lake_layout_and_pruning(spark, sf_small):
    ev = activity(spark, sf_small)
    path = lake.write_lake(ev, fresh_path(spark, "lake"))
    local = local_fs_path(path)
    dirs = sorted(d for d in os.listdir(local) if d.startswith("dt="))
    assert dirs[0].startswith("dt=2024-01-")
    assert all(d.startswith("action_part=") for d in os.listdir(os.path.join(local, dirs[0])))
    back = lake.read_lake(spark, path)
    assert back.count() == ev.count()
    pruned = lake.read_lake(spark, path, "2024-01-15", "2024-01-15", ["play"], ["movie_id", "event_time"])
    p = plan(pruned)
    assert "PartitionFilters: [isnotnull(dt" in p and "action" in p.split("PartitionFilters:")[1].split("]")[0]
    assert pruned.count() == ev.filter((F.to_date("event_time") == "2024-01-15") & (F.col("action") == "play")).count()


def test_lake_salted_write_same_rows(spark, sf_small):
    ev = activity(spark, sf_small)
    path = lake.write_lake(ev, fresh_path(spark, "lake"), files_per_partition=2, salt_cols=["event_id"])
    assert lake.read_lake(spark, path).count() == ev.count()


def test_lake_null_action_partition(spark):
    ev = events_df(spark, [(None, None, None, None, t(30), None), ("u", "play", "A", "X", t(30), None)])
    path = lake.write_lake(ev, fresh_path(spark, "lake"))
    got = sorted(rows(lake.partition_counts(lake.read_lake(spark, path)), "action", "n"), key=str)
    assert got == [("play", 1), (None, 1)] or got == [(None, 1), ("play", 1)]


def test_daily_monthly_reports(spark):
    ev = events_df(
        spark,
        [
            ("u", "play", "A", "X", dt.datetime(2024, 1, 1, 1), None),
            ("u", "rate", "A", "X", dt.datetime(2024, 1, 1, 2), 4),
            ("u", "like", "A", "X", dt.datetime(2024, 1, 2, 1), None),
            ("u", "rate", "A", "X", dt.datetime(2024, 1, 2, 3), 0),
        ],
    )
    daily = sorted(rows(reports.daily_report(ev), "day", "views", "likes", "avg_rating", "engagement_score"))
    assert daily == [(dt.date(2024, 1, 1), 1, 0, 4.0, 21.0), (dt.date(2024, 1, 2), 0, 1, 0.0, 2.0)]
    monthly = rows(reports.monthly_report(ev), "month", "views", "likes", "avg_rating")
    assert monthly == [(dt.date(2024, 1, 1), 1, 1, 2.0)]


def test_liked_pairs_and_latest_ratings(spark):
    ev = events_df(
        spark,
        [
            ("u1", "like", "A", "X", t(30), None),
            ("u1", "like", "A", "X", t(31), None),
            ("u2", "like", "A", "X", t(31), None),
            ("u1", "rate", "A", "X", t(30), 2),
            ("u1", "rate", "A", "X", t(32), 5),
            ("u1", "rate", "A", "X", t(32), 3),  # same time, later id: wins
            ("u2", "rate", "B", "X", t(31), 1),
        ],
    )
    assert sorted(rows(state.liked_pairs(ev))) == [("u1", "A"), ("u2", "A")]
    assert sorted(rows(state.latest_ratings(ev))) == [("u1", "A", 3), ("u2", "B", 1)]


def test_lake_rerun_replaces_its_partitions(spark, sf_small):
    ev = activity(spark, sf_small)
    path = fresh_path(spark, "lake")
    day1 = ev.filter(F.to_date("event_time") == "2024-01-10")
    day2 = ev.filter(F.to_date("event_time") == "2024-01-11")
    for part in (day1, day2, day1):  # day 1 loaded twice
        lake.write_lake(part, path, replace_partitions=True)
    back = lake.read_lake(spark, path)
    assert back.count() == day1.count() + day2.count()
