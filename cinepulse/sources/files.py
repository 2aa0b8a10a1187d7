"""File-based stand-in for the topic: Parquet files of (value BINARY, timestamp)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse import schema as S


def write_messages(messages: DataFrame, path: str, files: int | None = None, mode: str = "append", time_ordered: bool = False) -> str:
    """Land messages as Parquet files a file stream can pick up.

    With ``files`` = n the rows are split into n files by a hash of the payload
    (deterministic, so a retried task writes the same rows); with ``time_ordered``
    they are range-partitioned by message time instead, so file i holds older
    messages than file i+1 (costs a sampling pass over the input).
    """
    out = messages
    if files and time_ordered:
        out = messages.repartitionByRange(files, F.col("timestamp"))
    elif files:
        out = messages.repartition(files, F.xxhash64("value", "timestamp"))
    out.write.mode(mode).parquet(path)
    return path


REPLAY_ROWS_PER_FILE = 1_000_000
REPLAY_MIN_FILES = 8


def write_replay(df: DataFrame, path: str, time_col: str = "timestamp", rows_per_file: int = REPLAY_ROWS_PER_FILE, min_files: int = REPLAY_MIN_FILES) -> int:
    """Land ``df`` for a file stream that reads it in the order of ``time_col``; returns the
    number of files, which follows the number of rows.

    The rows are range-partitioned by time, so file i is older than file i + 1 (equal times
    share a file). A file stream goes by modification time, and tasks end in any order, so
    the files' times are set to their order afterwards: the watermark then moves from
    batch to batch and drops nothing. Needs a file system that can set times.
    """
    spark = df.sparkSession
    files = max(min_files, math.ceil(df.count() / rows_per_file))
    df.repartitionByRange(files, F.col(time_col)).write.mode("error").parquet(path)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith("part-")), key=lambda f: f.getName())
    newest = jvm.java.lang.System.currentTimeMillis()
    for i, f in enumerate(parts):
        fs.setTimes(f, newest - 1000 * (len(parts) - i), -1)
    return len(parts)


def read_message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame over the message files (declared schema, no inference)."""
    reader = spark.readStream.schema(S.MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.MESSAGE_SCHEMA).parquet(path)
