"""Runnable jobs that wire sources, operators and sinks together.

* ``streaming_job``: topic (or message files) -> decode -> trend, engagement and
  raw lake as three queries on one parsed stream; waits for any to end.
* ``sample_job``: the batch sample mode (ten sample events -> trend, engagement).
* ``snapshot_refresh``: one refresh of the live view from the lake, scanning only
  the ``dt`` partitions the trailing window can touch; ``snapshot_refresh_from_buckets``
  does it from the live bucket tables.
* ``daily_report_job`` / ``monthly_report_job``: the engagement report of one day
  or month, from its lake partitions only, replacing only its output partition.
* ``refresh_reports_job``: the mergeable day partials of both reports, of changed days only.

``python -m cinepulse.plans.jobs --help`` runs them from the command line.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse import schema as S
from cinepulse.functions.expressions import to_timedelta
from cinepulse.operators import day_partials, ingest, live, reports, windowed
from cinepulse.session import ensure_utc, shared_dir
from cinepulse.sources import files, kafka, lake, snapshot
from cinepulse.sources.fixtures import sample_events
from cinepulse.streaming import queries as streams


def streaming_job(
    spark: SparkSession,
    base_path: str,
    bootstrap_servers: str | None = None,
    message_path: str | None = None,
    window_duration: str = S.DEFAULT_WINDOW,
    watermark: str = streams.DEFAULT_WATERMARK,
    trigger: str | None = streams.DEFAULT_TRIGGER,
    state_partitions: int | None = None,
    wait: bool = True,
    live_buckets: str | None = None,
    with_intake: bool = False,
    topic: str = kafka.DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = 1000,
    complete_trend: bool = False,
    ranked: bool = False,
):
    """Start the streaming queries on one topic (or message files, for tests): trend,
    engagement and raw lake; with ``live_buckets`` (a bucket size such as
    ``"5 seconds"``) also the live pre-aggregation under ``base/live_buckets`` that
    ``snapshot_refresh_from_buckets`` reads; with ``with_intake`` also the
    accepted/quarantine intake under ``base/intake``. ``topic``, ``starting_offsets``
    and ``max_offsets_per_trigger`` (None: no limit) are the topic's source settings.

    The trend is appended once a window closes, so state stays bounded;
    ``complete_trend`` republishes all windows on each trigger instead. ``ranked`` adds
    the top-10 trend and top-20 engagement tables (``base/top_trending``,
    ``base/top_engagement``), re-ranked on each trigger: complete mode, whose state
    holds every window ever seen."""
    if bootstrap_servers:
        messages = kafka.read_kafka_stream(spark, bootstrap_servers, topic, starting_offsets, max_offsets_per_trigger)
    elif message_path:
        messages = files.read_message_stream(spark, message_path)
    else:
        raise ValueError("bootstrap_servers or message_path is required")
    events = ingest.parse_events(messages)
    queries = streams.start_all(events, base_path, window_duration, watermark, trigger, state_partitions, not complete_trend)
    ck = f"{base_path}/_checkpoints"
    if ranked:
        for name, start in (("top_trending", streams.start_top_trending), ("top_engagement", streams.start_top_engagement)):
            queries[name] = start(
                events, f"{ck}/{name}", f"{base_path}/{name}", window_duration,
                trigger=trigger, query_name=name, state_partitions=state_partitions,
            )
    if live_buckets:
        # fresh (stateless) buckets: the snapshot sees the last trigger's events
        buckets = streams.start_live_buckets(
            events, f"{base_path}/live_buckets", f"{ck}/live_buckets", live_buckets, watermark, trigger, "live_buckets",
            state_partitions, fresh=True,
        )
        queries.update({f"live_buckets_{k}": q for k, q in buckets.items()})
    if with_intake:
        queries["intake"] = streams.start_intake(messages, f"{base_path}/intake", f"{ck}/intake", trigger, "intake")
    if wait:
        if trigger in (None, "availableNow", "once"):
            streams.await_all(queries)
        else:
            spark.streams.awaitAnyTermination()
    return queries


def sample_job(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Top trending genres and top engagement scores of the ten sample events."""
    ev = sample_events(spark)
    return windowed.calculate_trending_genres(ev), windowed.calculate_engagement_score(ev)


def snapshot_refresh(
    spark: SparkSession,
    lake_path: str,
    snapshot_path: str,
    as_of: dt.datetime | None = None,
    window: str = S.DEFAULT_TRAILING,
) -> str:
    """Refresh the live snapshot table from the lake at ``as_of`` (default: now).

    The ``dt`` range [date(as_of - window), date(as_of)] is a partition filter, and
    the trailing predicate a literal, so only those partitions are read. Events dated
    after ``as_of`` (clock skew) count too, as in the live rules.
    """
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    first_day = (as_of - to_timedelta(window)).date()
    events = lake.read_lake(spark, lake_path, start=first_day)
    return snapshot.publish_live_snapshot(events, snapshot_path, as_of, window)


def snapshot_refresh_from_buckets(
    spark: SparkSession,
    buckets_path: str,
    snapshot_path: str,
    as_of: dt.datetime | None = None,
    window: str = S.DEFAULT_TRAILING,
    bucket: str = "5 seconds",
) -> str:
    """Refresh the live snapshot from ``start_live_buckets`` output (``genres/`` and
    ``movies/``): reads only window/bucket rows per key instead of raw events. The
    default instant is now, at the last edge of a ``bucket``: inside a bucket the
    oldest bucket of the window would be lost."""
    if as_of is None:
        now, size = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), to_timedelta(bucket)
        as_of = now - (now - dt.datetime.min) % size
    genres = spark.read.parquet(f"{buckets_path}/genres")
    movies = spark.read.parquet(f"{buckets_path}/movies")
    return snapshot.write_snapshot(live.trending_snapshot_from_buckets(genres, movies, as_of, window), snapshot_path)


def daily_report_job(spark: SparkSession, lake_path: str, out_path: str, day: dt.date | str) -> str:
    """Write the report of ``day`` to ``out_path/day=...``, replacing that partition only."""
    events = lake.read_lake(spark, lake_path, start=day, end=day)
    report = reports.daily_report(events)
    (
        report.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(out_path)
    )
    return out_path


def monthly_report_job(spark: SparkSession, lake_path: str, out_path: str, month: str) -> str:
    """Write the report of ``month`` (``YYYY-MM``) to ``out_path/month=...``, reading only
    that month's ``dt`` partitions and replacing only that month's output."""
    first = dt.date.fromisoformat(f"{month}-01")
    last = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    events = lake.read_lake(spark, lake_path, start=first, end=last)
    (
        reports.monthly_report(events)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(out_path)
    )
    return out_path


def refresh_reports_job(spark: SparkSession, lake_path: str, partials_path: str) -> day_partials.Refresh:
    """Bring the day partials up to date, reading only the days whose files changed.
    ``day_partials.daily_report`` and ``monthly_report`` read the reports from them."""
    return day_partials.refresh(spark, lake_path, partials_path)


def expire_live_buckets(spark: SparkSession, buckets_path: str, before: dt.date | str) -> list[str]:
    """Delete the live buckets of the days before ``before`` and return those folders.

    The buckets serve a trailing window only (history is read from the lake), so old
    days are dropped whole instead of being merged: nothing that a refresh reads is
    rewritten, and a running stream that appends a late row to an old day, or repeats
    a batch, changes no later answer. ``before`` must not be later than the first day
    that a trailing window can still touch.
    """
    before = dt.date.fromisoformat(before) if isinstance(before, str) else before
    jvm = spark.sparkContext._jvm
    gone = []
    for kind in ("genres", "movies"):
        root = jvm.org.apache.hadoop.fs.Path(f"{buckets_path}/{kind}")
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for folder in fs.listStatus(root) if fs.exists(root) else []:
            name, _, day = folder.getPath().getName().partition("=")
            if name == "dt" and day[:4].isdigit() and dt.date.fromisoformat(day) < before:
                fs.delete(folder.getPath(), True)
                gone.append(f"{kind}/dt={day}")
    return sorted(gone)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cinepulse.plans.jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    s = sub.add_parser("stream", help="streaming job")
    s.add_argument("--bootstrap-servers")
    s.add_argument("--message-path")
    s.add_argument("--base-path", help="output folder (default: below spark.checkpoint.dir)")
    s.add_argument("--trigger", default=streams.DEFAULT_TRIGGER)
    s.add_argument("--live-buckets", help="bucket size for the live pre-aggregation, e.g. '5 seconds'")
    s.add_argument("--topic", default=kafka.DEFAULT_TOPIC)
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--max-offsets-per-trigger", type=int, default=1000, help="0: no limit")
    s.add_argument("--intake", action="store_true", help="also land accepted/quarantined messages")
    s.add_argument("--window", default=S.DEFAULT_WINDOW)
    s.add_argument("--watermark", default=streams.DEFAULT_WATERMARK)
    s.add_argument("--state-partitions", type=int, help="state stores of each stateful query, fixed at its first start")
    s.add_argument("--complete-trend", action="store_true", help="republish all trend windows on each trigger")
    s.add_argument("--ranked", action="store_true", help="also keep the top-10 trend and top-20 engagement tables")
    sub.add_parser("sample", help="batch sample mode")
    r = sub.add_parser("snapshot", help="refresh the live snapshot from the lake or from live buckets")
    src = r.add_mutually_exclusive_group(required=True)
    src.add_argument("--lake")
    src.add_argument("--buckets")
    r.add_argument("--out", required=True)
    d = sub.add_parser("daily-report", help="report of one day from the lake")
    d.add_argument("--lake", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--day", required=True)
    c = sub.add_parser("expire-buckets", help="delete the live buckets of old days")
    c.add_argument("--buckets", required=True)
    c.add_argument("--before", required=True, help="YYYY-MM-DD: delete the days before this one")
    f = sub.add_parser("refresh-reports", help="recompute the report partials of the days whose lake files changed")
    f.add_argument("--lake", required=True)
    f.add_argument("--partials", required=True)
    m = sub.add_parser("monthly-report", help="report of one month from the lake")
    m.add_argument("--lake", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--month", required=True, help="YYYY-MM")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"cinepulse-{args.job}").getOrCreate()
    ensure_utc(spark)
    try:
        if args.job == "stream":
            base = args.base_path or f"{shared_dir(spark)}/cinepulse/stream-job"
            streaming_job(
                spark, base, args.bootstrap_servers, args.message_path, args.window, args.watermark, args.trigger,
                args.state_partitions, live_buckets=args.live_buckets, with_intake=args.intake, topic=args.topic,
                starting_offsets=args.starting_offsets, max_offsets_per_trigger=args.max_offsets_per_trigger or None,
                complete_trend=args.complete_trend, ranked=args.ranked,
            )
        elif args.job == "sample":
            trend, engagement = sample_job(spark)
            trend.show(truncate=False)
            engagement.show(truncate=False)
        elif args.job == "snapshot" and args.buckets:
            snapshot_refresh_from_buckets(spark, args.buckets, args.out)
        elif args.job == "snapshot":
            snapshot_refresh(spark, args.lake, args.out)
        elif args.job == "daily-report":
            daily_report_job(spark, args.lake, args.out, args.day)
        elif args.job == "refresh-reports":
            print(refresh_reports_job(spark, args.lake, args.partials))
        elif args.job == "expire-buckets":
            expire_live_buckets(spark, args.buckets, args.before)
        elif args.job == "monthly-report":
            monthly_report_job(spark, args.lake, args.out, args.month)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
