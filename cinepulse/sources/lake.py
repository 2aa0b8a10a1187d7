"""The raw event lake: Parquet partitioned by ``dt`` (event date) and action.

Layout ``<path>/dt=YYYY-MM-DD/action_part=<play|like|rate|other>/part-*.parquet``;
``dt`` comes from each row's own event time. Actions are free text, so the folder holds
one of four parts and the true action stays a data column: an empty, NULL or
number-like action reads back as it was, and odd texts make no new folders. Reads with
a ``dt``/action predicate are pruned to the matching directories (``PartitionFilters``
in the plan).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinepulse import schema as S

ACTION_PART = "action_part"
OTHER_ACTION = "other"
KNOWN_ACTIONS = [S.ACTION_PLAY, S.ACTION_LIKE, S.ACTION_RATE]
PARTITION_COLUMNS = ["dt", ACTION_PART]
DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000


def with_partition_columns(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    part = F.when(F.col("action").isin(KNOWN_ACTIONS), F.col("action")).otherwise(F.lit(OTHER_ACTION))
    return events.withColumns({"dt": F.to_date(F.col(time_col)), ACTION_PART: part})


def stored_schema(events: DataFrame, time_col: str = "event_time") -> T.StructType:
    """Schema of the lake that ``write_lake`` makes of ``events``."""
    return with_partition_columns(events, time_col).schema


def write_lake(
    events: DataFrame,
    path: str,
    time_col: str = "event_time",
    mode: str = "append",
    files_per_partition: int | None = None,
    salt_cols: list[str] | None = None,
    max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
    writers: int | None = None,
    replace_partitions: bool = False,
) -> str:
    """Write events to the lake.

    ``replace_partitions``: replace exactly the (dt, action part) partitions present in
    ``events`` (dynamic partition overwrite) instead of appending, so re-running a
    load after a failure or by mistake leaves the lake as one run would.

    Default: rows are rebalanced by partition. Adaptive execution splits a hot
    partition over several writers and lets one writer take several small ones, both
    by the advisory partition size, so the file count follows the bytes and not tasks
    x partitions. With ``files_per_partition`` = n the rows are hash-partitioned on
    (dt, action part, salt in 0..n-1) instead: a fixed number of files per partition.
    The salt is a hash of the row (``salt_cols``), so a retried task rewrites the same
    rows. ``writers`` (default: ``spark.sql.shuffle.partitions``) is the number of
    write tasks; it is explicit so that adaptive execution does not fold a small
    shuffle into a single writer. Each (dt, action part, salt) group still lands in
    exactly one task, so the file count does not depend on it.
    """
    out = with_partition_columns(events, time_col)
    if files_per_partition:
        cols = salt_cols or list(events.columns)
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(files_per_partition))
        n = writers or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartition(n, *PARTITION_COLUMNS, salt)
    else:
        out = out.hint("rebalance", *PARTITION_COLUMNS)
    writer = out.write.option("maxRecordsPerFile", str(max_records_per_file)).partitionBy(*PARTITION_COLUMNS)
    if replace_partitions:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)
    return path


def read_lake(
    spark: SparkSession,
    path: str,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    actions: list[str] | None = None,
    columns: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Lake rows with ``start <= dt <= end`` and ``action in actions`` (each optional).
    ``schema`` (``stored_schema`` of the events) also reads a lake without any row."""
    # The partition columns' types are declared, not inferred from folder names.
    found = schema or spark.read.option("basePath", path).parquet(path).schema
    types = {"dt": T.DateType(), ACTION_PART: T.StringType()}
    schema = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in found])
    df = spark.read.schema(schema).option("basePath", path).parquet(path)
    if start is not None:
        df = df.filter(F.col("dt") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("dt") <= F.lit(end).cast("date"))
    if actions is not None:
        parts = {a if a in KNOWN_ACTIONS else OTHER_ACTION for a in actions}
        df = df.filter(F.col(ACTION_PART).isin(sorted(parts)) & F.col("action").isin(list(actions)))
    return df.select(*columns) if columns else df.drop(ACTION_PART)


def partition_counts(lake: DataFrame) -> DataFrame:
    """Rows per (dt, action)."""
    return lake.groupBy("dt", "action").agg(F.count(F.lit(1)).alias("n"))


def write_intake(classified: DataFrame, path: str, mode: str = "append", replace_partitions: bool = False) -> str:
    """Land ``operators.ingest.intake`` output partitioned by ``dt`` (message date) and
    ``status`` (accepted / rejected): both tables in one job. ``replace_partitions``
    replaces the (dt, status) partitions written, so re-running a day's intake does
    not duplicate rows."""
    out = classified.withColumn("dt", F.to_date("event_time"))
    writer = out.write.partitionBy("dt", "status")
    if replace_partitions:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)
    return path
