"""Cases in which published tables or parsed times used to go wrong."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinepulse.functions.clock import parse_iso_timestamp
from cinepulse.session import fresh_path
from cinepulse.sources import lake
from cinepulse.sources.versioned import publish_each_batch, read_latest, write_version

BAD = ["2024", "2024-01", " 2024-01-15T10:30:00 ", "2024-1-5T1:2:3", "2024-01-15 10:30:00 Europe/Paris", "10:30:00", "T10:30", "", "2024-13-01", None]
GOOD = {
    "2024-01-15": dt.datetime(2024, 1, 15),
    "2024-01-15T10": dt.datetime(2024, 1, 15, 10),
    "2024-01-15T10:30": dt.datetime(2024, 1, 15, 10, 30),
    "2024-01-15 10:30:00": dt.datetime(2024, 1, 15, 10, 30),
    "2024-01-15T10:30:00.25Z": dt.datetime(2024, 1, 15, 10, 30, 0, 250000),
    "2024-01-15T10:30:00+02:00": dt.datetime(2024, 1, 15, 8, 30),
    "20240115T103000": dt.datetime(2024, 1, 15, 10, 30),
}


def test_only_iso_instants_parse(spark):
    rows = spark.createDataFrame([(t,) for t in [*BAD, *GOOD]], "t string").select("t", parse_iso_timestamp("t").alias("p")).collect()
    assert {r.t: r.p for r in rows} == {**dict.fromkeys(BAD), **GOOD}


def test_empty_version_replaces_the_last(spark):
    path, df = fresh_path(spark, "versions"), spark.range(3)
    write_version(df, path, 1)
    write_version(df.limit(0), path, 2)
    assert read_latest(spark, path).columns == ["id"] and read_latest(spark, path).count() == 0


def test_new_checkpoint_publishes_newer_versions(spark):
    path, source = fresh_path(spark, "versions"), fresh_path(spark, "source")
    spark.range(5).write.parquet(source)

    def run(checkpoint):
        counts = spark.readStream.schema("id long").parquet(source).groupBy().agg(F.count("*").alias("n"))
        writer = counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(publish_each_batch(path))
        writer.trigger(availableNow=True).start().awaitTermination()

    run(fresh_path(spark, "ckpt"))
    spark.range(7).write.mode("append").parquet(source)
    run(fresh_path(spark, "ckpt"))  # batch ids start at 0 again
    assert read_latest(spark, path).first().n == 12


def test_replayed_batch_is_published_once(spark):
    path = fresh_path(spark, "versions")
    publish = publish_each_batch(path, keep=5)
    publish(spark.range(2), 0)
    publish(spark.range(2), 0)
    with pytest.raises(FileNotFoundError):
        read_latest(spark, fresh_path(spark, "none"))
    write_version(spark.range(9), path, 1, keep=5)
    publish(spark.range(2), 0)
    assert read_latest(spark, path).count() == 9


def test_lake_keeps_actions_as_text(spark):
    rows = [(a, dt.datetime(2024, 1, 15, 10)) for a in ("01", "1", "play", "", None, "odd/../action")]
    path = lake.write_lake(spark.createDataFrame(rows, "action string, event_time timestamp_ntz"), fresh_path(spark, "lake"))
    got = lake.read_lake(spark, path)
    assert sorted((r.action for r in got.collect()), key=str) == ["", "01", "1", None, "odd/../action", "play"]
    assert [r.action for r in lake.read_lake(spark, path, actions=["1"]).collect()] == ["1"]
    assert got.columns == ["action", "event_time", "dt"]


def _files(spark, path):
    return len(spark.read.parquet(path).inputFiles())


def test_lake_files_follow_size(spark):
    hot = spark.range(0, 60_000, 1, 32).selectExpr(
        "uuid() AS user_id", "CASE WHEN id % 100 = 0 THEN 'like' ELSE 'play' END AS action", "timestamp_ntz'2024-01-15 10:00:00' AS event_time"
    )
    assert _files(spark, lake.write_lake(hot, fresh_path(spark, "lake"))) == 2  # 32 tasks, two small partitions
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "200k")
    try:
        path = lake.write_lake(hot, fresh_path(spark, "lake"))
    finally:
        spark.conf.unset(key)
    assert _files(spark, f"{path}/dt=2024-01-15/action_part=play") > 2  # several writers of the hot partition
    assert lake.read_lake(spark, path).count() == 60_000


def test_lake_without_rows(spark):
    ev = spark.createDataFrame([], "action string, event_time timestamp_ntz")
    path = lake.write_lake(ev, fresh_path(spark, "lake"))
    assert lake.read_lake(spark, path, schema=lake.stored_schema(ev)).count() == 0
