"""Scaling probe: time key operators on sf0.1 events replicated n times inside Spark.

Each copy of an event gets a distinct event_id and keeps its time, user and movie,
so group sizes grow n-fold (the hot-key case grows with them). With ``--skew`` every
third copy is moved to movie 0, which then holds over a third of all rows.
Usage: python scripts/scale_probe.py [copies ...] [--skew] [--eventlog] [--salted N]

With ``--eventlog`` Spark's event log is written to a fresh scratch folder and, per
operator, the imbalance of its shuffle reads is reported: for each reduce stage the
largest share of the stage's shuffle records that one task read.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cinepulse.functions.clock import resolve_as_of  # noqa: E402
from cinepulse.operators import live, state, windowed  # noqa: E402
from cinepulse.session import local_session  # noqa: E402
from cinepulse.sources import adapter  # noqa: E402

SF = "/root/testdata/sf0.1"


def replicated(spark, copies: int, skew: bool, salted: int | None = None):
    # The test table is one row group (one scan task): spread its 100k rows over 16
    # tasks first, so the replicated rows are produced in parallel as a real scan's.
    ev = adapter.table(spark, SF, "events").repartition(16, "event_id")
    n = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    out = ev.select("*", n).withColumn("event_id", F.col("event_id") * copies + F.col("copy"))
    if skew:
        out = out.withColumn("props", F.when(F.col("copy") % 3 == 0, F.lit('{"k": 0}')).otherwise(F.col("props")))
    part = adapter.table(spark, SF, "part")
    if salted:  # force the shuffle join (no broadcast) with this many salts; 1 = plain
        return adapter.activity_from(out.drop("copy"), part, max_broadcast_bytes=0, salt_buckets=salted)
    return adapter.activity_from(out.drop("copy"), part)


def largest_task_share(log_dir: str) -> dict[str, float]:
    """Per job group: the largest share of a reduce stage's shuffle records that one
    task read (max over the group's stages). A hot key that lands whole in one
    reducer shows up as its share of the rows (about 0.33 here)."""
    stage_group, records = {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    read = ((ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if read:
                        records.setdefault(ev["Stage ID"], []).append(read)
    out: dict[str, float] = {}
    for sid, reads in records.items():
        group = stage_group.get(sid)
        if group and len(reads) > 1:
            out[group] = round(max(out.get(group, 0.0), max(reads) / sum(reads)), 3)
    return out


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("copies", nargs="*", type=int, default=[1, 10, 50])
    parser.add_argument("--skew", action="store_true", help="one movie gets over a third of all rows")
    parser.add_argument("--eventlog", action="store_true", help="report shuffle imbalance from the event log")
    parser.add_argument("--salted", type=int, help="force the shuffle join with this many salts (1 = plain)")
    parser.add_argument("--no-aqe-skew", action="store_true", help="turn off adaptive execution's skew-join split")
    args = parser.parse_args()
    copies, skew, salted = args.copies, args.skew, args.salted
    extra = {}
    if salted:  # keep Spark from broadcasting the small test dimension on its own
        extra.update({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    if args.no_aqe_skew:
        extra["spark.sql.adaptive.skewJoin.enabled"] = "false"
    if args.eventlog:
        log_dir = tempfile.mkdtemp(prefix="cinepulse-eventlog-")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"})
        # Every reduce stage keeps its 64 tasks, so an even spread is a share of ~1/64.
        extra["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    spark = local_session(8, shuffle_partitions=64, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    for n in copies:
        ev = replicated(spark, n, skew, salted)
        as_of = resolve_as_of(ev)
        ops = {
            "engagement_windows": lambda: windowed.engagement_scores(ev),
            "engagement_top20": lambda: windowed.calculate_engagement_score(ev),
            "live_movie_scores": lambda: live.live_movie_scores(ev, as_of, "1 day"),
            "latest_ratings": lambda: state.latest_ratings(ev),
            "liked_pairs": lambda: state.liked_pairs(ev),
        }
        times = {}
        for name, build in ops.items():
            spark.sparkContext.setJobGroup(f"{n}:{name}", name)
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 2)
        print(json.dumps({"copies": n, "rows": 100_000 * n, "skew": skew, "salted": salted, "sec": times}))
    spark.stop()
    if args.eventlog:
        print(json.dumps({"skew": skew, "salted": salted, "largest_task_share": largest_task_share(extra["spark.eventLog.dir"])}))


if __name__ == "__main__":
    main()
