"""The live view at any instant, over any trailing window: an exact index of time.

The index holds the events by day (``raw``), and live partial aggregates per time bucket
on several levels, each level's bucket a whole number of the finer level's: by default a
minute, an hour and a day. A coarser level is merged from the finer one, so the events are
aggregated once. All tables are partitioned by ``dt``, the day of the bucket; replacing a
day's partitions brings the index up to date for that day alone.

A window (lower, upper] is covered by at most two ranges on each level but the coarsest
and one on that: the events of the two cut minutes, then the whole minutes up to an hour's
edge, the whole hours up to a day's edge, the whole days. So a view reads at most 2 x 59
minute rows, 2 x 23 hour rows and the day rows of a key, and the events of two
minutes, whatever the traffic, and equals the view computed from the events.

Buckets are (start, end] in event time, as in ``operators.live``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinepulse import schema as S
from cinepulse.functions.expressions import engagement_score, to_timedelta, truthy
from cinepulse.operators import live

LEVELS = ("1 minute", "1 hour", "1 day")
EPOCH = dt.datetime(1970, 1, 1)
RAW = "raw"
SCHEMA = "schema"  # an empty file with the columns of the events
KINDS = {"genres": live.genre_buckets, "movies": live.movie_buckets}
#: How partial rows of a key are merged; the order key ``first_seen`` comes last.
_SUMS = {"genres": ["score"], "movies": ["views", "likes", "total_rating", "rating_count"]}
_KEY = {"genres": "genre", "movies": "movie_id"}


def _merged(partials: DataFrame, kind: str, keys: Sequence[str]) -> DataFrame:
    first = [F.min_by("genre", "first_seen").alias("genre")] if kind == "movies" else []
    return partials.groupBy(*keys, _KEY[kind]).agg(
        *first, *[F.sum(c).cast("long").alias(c) for c in _SUMS[kind]], F.min("first_seen").alias("first_seen")
    )


def _folder(path: str, kind: str, level: str) -> str:
    return f"{path}/{kind}/{level.replace(' ', '-')}"


def write_index(events: DataFrame, path: str, levels: Sequence[str] = LEVELS) -> str:
    """Write the index of ``events``, or replace the days that are in ``events`` in full.

    Each level's table is written from the one before it as it was stored, restricted to
    the same days, so a repeated load leaves the same index. Events without a time are
    in no window and left out.
    """
    _check(levels)
    spark = events.sparkSession
    events.limit(0).write.mode("overwrite").parquet(f"{path}/{SCHEMA}")
    timed = live.with_bucket_time(events.filter(F.col("event_time").isNotNull())).withColumn("dt", F.to_date(live.BUCKET_TIME))
    _replace(timed.drop(live.BUCKET_TIME).hint("rebalance", "dt").sortWithinPartitions("dt", "event_time"), f"{path}/{RAW}")
    days = [r["dt"] for r in timed.select("dt").distinct().collect()]  # one row a day
    stored = _read(spark, path, RAW, RAW).filter(F.col("dt").isin(days)) if days else events.limit(0)
    for kind, build in KINDS.items():
        table = build(stored, levels[0])
        for i, level in enumerate(levels):
            if i:
                finer = _read(spark, path, kind, levels[i - 1]).filter(F.col("dt").isin(days))
                start = F.window("bucket_start", level)["start"]
                table = _merged(finer.withColumn("bucket_start", start), kind, ["bucket_start"])
            _replace(table.withColumn("dt", F.to_date("bucket_start")).hint("rebalance", "dt"), _folder(path, kind, level))
    return path


def _replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)


def _check(levels: Sequence[str]) -> list[dt.timedelta]:
    sizes = [to_timedelta(x) for x in levels]
    day = dt.timedelta(days=1)
    if not sizes or any(b % a for a, b in zip(sizes, [*sizes[1:], day])):
        raise ValueError(f"each level must divide the next one, and the last one a day: {levels}")
    return sizes


def cover(lower: dt.datetime, upper: dt.datetime, levels: Sequence[str] = LEVELS) -> list[tuple[str, dt.datetime, dt.datetime]]:
    """Disjoint ranges (level, from, to] that make up (lower, upper]; level ``raw`` is cut freely."""
    out, names = [], [RAW, *levels]
    sizes = [dt.timedelta(microseconds=1), *_check(levels)]
    for name, size in zip(names, sizes[1:]):
        low, high = -(-(lower - EPOCH) // size) * size + EPOCH, (upper - EPOCH) // size * size + EPOCH
        if low >= high:
            out.append((name, lower, upper))
            return [r for r in out if r[1] < r[2]]
        out += [(name, lower, low), (name, high, upper)]
        lower, upper = low, high
    out.append((names[-1], lower, upper))
    return [r for r in out if r[1] < r[2]]


def _read(spark: SparkSession, path: str, kind: str, level: str) -> DataFrame:
    """A table of the index, with its declared columns (an index without events has no files)."""
    empty = spark.createDataFrame([], spark.read.parquet(f"{path}/{SCHEMA}").schema)
    folder, rows = (f"{path}/{RAW}", empty) if level == RAW else (_folder(path, kind, level), KINDS[kind](empty, LEVELS[0]))
    declared = T.StructType([*rows.schema.fields, T.StructField("dt", T.DateType())])
    return spark.read.schema(declared).option("basePath", folder).parquet(folder)


def _days(ranges: Sequence[tuple[dt.datetime, dt.datetime]]) -> list[dt.date]:
    """The ``dt`` values of the buckets in these ranges (from, to]."""
    out: set[dt.date] = set()
    for low, high in ranges:
        last = (high - dt.timedelta(microseconds=1)).date()
        out |= {low.date() + dt.timedelta(days=i) for i in range((last - low.date()).days + 1)}
    return sorted(out)


def _stamp(t: dt.datetime):
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def partials_at(
    spark: SparkSession, path: str, kind: str, instants: Sequence[tuple[dt.datetime, str | dt.timedelta]], levels: Sequence[str] = LEVELS
) -> DataFrame:
    """Merged partial rows of each (instant, trailing window): as_of, the key and its figures.

    One scan a level serves all instants: the buckets that each of them needs are a small
    table (no more than some hundred rows an instant), joined on the bucket; the events of
    cut buckets are joined on theirs and held against the exact ends.
    """
    wanted: dict[str, list[tuple[dt.datetime, dt.datetime, dt.datetime]]] = {}
    for as_of, window in instants:
        size = to_timedelta(window) if isinstance(window, str) else window
        for level, low, high in cover(as_of - size, as_of, levels):
            wanted.setdefault(level, []).append((as_of, low, high))
    parts = []
    for level, ranges in wanted.items():
        unit = to_timedelta(levels[0] if level == RAW else level)
        rows = []
        for as_of, low, high in ranges:
            at = (low - EPOCH) // unit * unit + EPOCH
            while at < high:
                rows.append((as_of.isoformat(" "), at.isoformat(" "), low.isoformat(" "), high.isoformat(" ")))
                at += unit
        names = ["as_of", "bucket_start", "low", "high"]
        probes = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).select(*[F.col(n).cast("timestamp_ntz").alias(n) for n in names])
        table = _read(spark, path, kind, level).filter(F.col("dt").isin(_days([r[1:] for r in ranges])))
        if level == RAW:
            first, last = min(r[1] for r in ranges), max(r[2] for r in ranges)
            near = table.filter((F.col("event_time") > _stamp(first)) & (F.col("event_time") <= _stamp(last)))
            near = live.with_bucket_time(near).withColumn("bucket_start", F.window(live.BUCKET_TIME, levels[0])["start"]).drop(live.BUCKET_TIME)
            inside = near.join(F.broadcast(probes), "bucket_start").filter("event_time > low and event_time <= high")
            # One bucket an instant is enough: the partial rows are merged below.
            parts.append(_raw_partials(inside, kind))
        else:
            parts.append(table.join(F.broadcast(probes), "bucket_start").drop("bucket_start", "dt", "low", "high"))
    if not parts:
        return _merged(_read(spark, path, kind, levels[0]).withColumn("as_of", F.col("bucket_start")).limit(0), kind, ["as_of"])
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return _merged(union, kind, ["as_of"])


def _raw_partials(events: DataFrame, kind: str) -> DataFrame:
    if kind == "genres":
        return events.filter(truthy("genre")).groupBy("as_of", "genre").agg(*live.genre_figures(events))
    return events.filter(truthy("movie_id")).groupBy("as_of", "movie_id").agg(*live.movie_figures(events))


def _top(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("as_of").orderBy(*live.live_order())
    return scored.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= k)


def live_genres_at(spark: SparkSession, path: str, instants, k: int = S.TOP_LIVE_GENRES, levels: Sequence[str] = LEVELS) -> DataFrame:
    """as_of, position, genre, score: the live genre list of each (instant, window)."""
    return _top(partials_at(spark, path, "genres", instants, levels), k).select("as_of", "position", "genre", "score")


def live_movies_at(spark: SparkSession, path: str, instants, k: int = S.TOP_LIVE_MOVIES, levels: Sequence[str] = LEVELS) -> DataFrame:
    """as_of, position and the live movie list of each (instant, window)."""
    merged = partials_at(spark, path, "movies", instants, levels)
    mean = F.when(F.col("rating_count") > 0, F.col("total_rating").cast("double") / F.col("rating_count")).otherwise(F.lit(0.0))
    scored = merged.withColumn("avg_rating", mean).withColumn("score", engagement_score())
    return _top(scored, k).select("as_of", "position", "movie_id", "genre", "score", "views", "likes", "avg_rating")
