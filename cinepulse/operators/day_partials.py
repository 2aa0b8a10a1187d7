"""Incremental reports: mergeable partials by day, of which only changed days are recomputed.

The table keeps one part per lake day with counts and rating sums by movie and genre (no
averages, which cannot be merged). ``refresh`` lists the lake's files without opening them and
compares one signature per ``dt`` folder (names, sizes, times) with the one that the manifest
holds: days with a new, lost or rewritten file are read and aggregated anew, all in one job,
and one manifest swap publishes them with their signatures; vanished days are dropped.
Signatures are taken before the rows are read, so a file that lands in between makes its day
change once more at the next refresh. A daily report is a read of its part, a month the sum of
its days' parts; raw events are read once for both.

Events without a time lie in the day folder of NULL and are a day of their own; an empty lake
has no day. Ratings are whole numbers, so sums do not depend on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinepulse import schema as S
from cinepulse.functions.expressions import engagement_score, is_action
from cinepulse.operators.reports import METRICS
from cinepulse.sources import lake, manifest

#: Folder name that Spark gives to a NULL partition value.
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
SUMS = ["views", "likes", "rating_sum", "rating_count"]
SCHEMA = T.StructType(
    [
        T.StructField("dt", T.DateType()),
        T.StructField("movie_id", T.StringType()),
        T.StructField("genre", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in SUMS],
    ]
)


@dataclass
class Refresh:
    recomputed: list[str]
    dropped: list[str]


def day_signatures(spark: SparkSession, lake_path: str) -> DataFrame:
    """day (folder name), signature: one row per ``dt`` folder that holds a file. Reads file
    names, sizes and times only; a streamed lake's own log decides which files count."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(lake_path)
    one = F.xxhash64("path", "length", "modificationTime")
    per_day = files.groupBy(F.regexp_extract("path", r"/dt=([^/]+)/", 1).alias("day"))
    return per_day.agg(F.xxhash64(F.bit_xor(one), F.count(F.lit(1)), F.sum("length")).alias("signature"))


def partials(events: DataFrame) -> DataFrame:
    """Mergeable sums of lake rows by (dt, movie_id, genre)."""
    rating = F.when(is_action(S.ACTION_RATE), F.col("rating_value"))
    return events.groupBy("dt", "movie_id", "genre").agg(
        F.count(F.when(is_action(S.ACTION_PLAY), F.lit(1))).alias("views"),
        F.count(F.when(is_action(S.ACTION_LIKE), F.lit(1))).alias("likes"),
        F.sum(rating).cast("long").alias("rating_sum"),
        F.count(rating).alias("rating_count"),
    )


def _folders(spark: SparkSession, path: str) -> set[str]:
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {st.getPath().getName() for st in fs.listStatus(root)}


def refresh(spark: SparkSession, lake_path: str, path: str, schema: T.StructType | None = None) -> Refresh:
    """Bring the partials at ``path`` up to date with the lake; returns the days it touched."""
    now = manifest.read_manifest(spark, path)
    # One row per calendar day of the lake: bounded by its age, not by its rows.
    found = {r["day"]: r["signature"] for r in day_signatures(spark, lake_path).collect()}
    changed = sorted(d for d, s in found.items() if now.marks.get(d) != s)
    gone = sorted(d for d in now.marks if d not in found)
    if not changed and not gone:
        return Refresh([], [])
    fresh: dict[str, str] = {}
    if changed:
        days = [d for d in changed if d != NULL_DAY]
        wanted = F.col("dt").isin([F.lit(d).cast("date") for d in days]) if days else F.lit(False)
        if NULL_DAY in changed:
            wanted = wanted | F.col("dt").isNull()
        rows = partials(lake.read_lake(spark, lake_path, schema=schema).filter(wanted))
        folder = manifest.new_folder()
        rows.hint("rebalance", "dt").write.partitionBy("dt").parquet(f"{path}/{folder}")
        written = _folders(spark, f"{path}/{folder}")  # a day of files without rows has no folder
        fresh = {d: f"{folder}/dt={d}" for d in changed if f"dt={d}" in written}

    def swap(at: manifest.Manifest):
        touched = {*changed, *gone}
        parts = {d: f for d, f in at.parts.items() if d not in touched} | fresh
        marks = {d: s for d, s in at.marks.items() if d not in touched} | {d: found[d] for d in changed}
        return parts, marks

    # After a conflict the days of the other writer are replaced together with their
    # signatures, so whatever is older than the lake is found by the next refresh.
    manifest.update(spark, path, swap)
    return Refresh(changed, gone)


def read_partials(spark: SparkSession, path: str, month: str | None = None) -> DataFrame:
    """Partials of all days, or of one month (``YYYY-MM``), as of one manifest."""
    now = manifest.read_manifest(spark, path)
    return manifest.read_parts(spark, path, SCHEMA, now, [d for d in now.parts if month is None or d.startswith(f"{month}-")])


def _metrics(sums: DataFrame, first: str) -> DataFrame:
    mean = F.when(F.col("rating_count") > 0, F.col("rating_sum").cast("double") / F.col("rating_count")).otherwise(F.lit(0.0))
    return sums.withColumn("avg_rating", mean).withColumn("engagement_score", engagement_score()).select(first, "movie_id", "genre", *METRICS)


def daily_report(spark: SparkSession, path: str, month: str | None = None) -> DataFrame:
    """``reports.daily_report`` of the lake as of the last refresh; no shuffle."""
    return _metrics(read_partials(spark, path, month).withColumnRenamed("dt", "day"), "day")


def monthly_report(spark: SparkSession, path: str, month: str | None = None) -> DataFrame:
    """``reports.monthly_report`` of the lake as of the last refresh, summed from its days."""
    days = read_partials(spark, path, month).withColumn("month", F.trunc("dt", "month"))
    return _metrics(days.groupBy("month", "movie_id", "genre").agg(*[F.sum(c).alias(c) for c in SUMS]), "month")
