"""Jobs: sample mode, streaming job, snapshot refresh and daily report from the lake."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from cinepulse.operators import day_partials, ingest, reports
from cinepulse.plans import jobs
from cinepulse.session import fresh_path
from cinepulse.sources import files, kafka, lake
from cinepulse.sources.adapter import activity

from helpers import plan, rows


def test_sample_job(spark):
    trend, engagement = jobs.sample_job(spark)
    assert rows(trend, "genre", "activity_count")[:2] == [("Sci-Fi", 3), ("Action", 2)]
    assert rows(engagement, "movie_id")[:3] == [("D",), ("G",), ("A",)]


def test_streaming_job_from_files(spark, sf_small):
    ev = activity(spark, sf_small)
    src = files.write_messages(ingest.to_messages(ev), fresh_path(spark, "msgs"), files=2)
    base = fresh_path(spark, "job")
    qs = jobs.streaming_job(
        spark, base, message_path=src, window_duration="1 day", trigger="availableNow", state_partitions=4,
        live_buckets="1 minute", with_intake=True,
    )
    assert set(qs) == {"trending", "engagement", "raw_lake", "live_buckets_fresh", "intake"}
    assert lake.read_lake(spark, f"{base}/lake").count() == ev.count()
    assert spark.read.parquet(f"{base}/intake").filter("status = 'accepted'").count() == ev.filter("genre is not null").count()
    snap = jobs.snapshot_refresh_from_buckets(spark, f"{base}/live_buckets", fresh_path(spark, "snap"), dt.datetime(2024, 1, 20), "1 day")
    from cinepulse.sources import snapshot

    assert snapshot.read_snapshot(spark, snap).count() > 0


def test_snapshot_refresh_prunes_days(spark, sf_small):
    ev = activity(spark, sf_small)
    path = lake.write_lake(ev, fresh_path(spark, "lake"))
    as_of = dt.datetime(2024, 1, 20, 12, 0)
    out = jobs.snapshot_refresh(spark, path, fresh_path(spark, "snap"), as_of, "1 day")
    from cinepulse.sources import snapshot

    snap = snapshot.read_snapshot(spark, out)
    assert 0 < snap.count() <= 15
    pruned = lake.read_lake(spark, path, start=dt.date(2024, 1, 19))
    assert "PartitionFilters: [isnotnull(dt" in plan(pruned)


def test_daily_report_job_replaces_one_day(spark, sf_small):
    ev = activity(spark, sf_small)
    path = lake.write_lake(ev, fresh_path(spark, "lake"))
    out = fresh_path(spark, "report")
    for day in ["2024-01-10", "2024-01-11", "2024-01-10"]:  # rerun of a day replaces it
        jobs.daily_report_job(spark, path, out, day)
    got = spark.read.parquet(out)
    assert sorted(r.day.isoformat() for r in got.select("day").distinct().collect()) == ["2024-01-10", "2024-01-11"]
    want = reports.daily_report(ev).filter("day = date'2024-01-10'")
    assert got.filter("day = date'2024-01-10'").count() == want.count()


def test_kafka_source_needs_connector(spark):
    # The connector jar is not bundled with PySpark; the call path reaches Spark's lookup.
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka.read_kafka_stream(spark, "localhost:9092")


def test_monthly_report_job(spark, sf_small):
    ev = activity(spark, sf_small)
    path = lake.write_lake(ev, fresh_path(spark, "lake"))
    out = jobs.monthly_report_job(spark, path, fresh_path(spark, "monthly"), "2024-01")
    got = sorted(rows(spark.read.parquet(out), "movie_id", "genre", "views", "likes"), key=str)
    want = sorted(rows(reports.monthly_report(ev), "movie_id", "genre", "views", "likes"), key=str)
    assert got == want


def test_refresh_reports_job_without_a_declared_schema(spark, sf_small):
    ev = activity(spark, sf_small)
    path, out = lake.write_lake(ev, fresh_path(spark, "lake")), fresh_path(spark, "partials")
    assert jobs.refresh_reports_job(spark, path, out).recomputed
    assert not jobs.refresh_reports_job(spark, path, out).recomputed
    got, want = day_partials.monthly_report(spark, out, "2024-01"), reports.monthly_report(ev)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
