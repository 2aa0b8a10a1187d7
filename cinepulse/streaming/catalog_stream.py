"""A stored catalogue log, and events as a stream joined with the versions valid at their time.

The log is a table of parts (``sources.manifest``): every batch of changes is one part, added
once. A micro-batch of events pins the newest manifest and joins that history, so it sees what
was published before it ran, also by other jobs, and a repeated batch writes nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cinepulse.operators.catalog_history import CHANGE_SCHEMA, changes_of, history, join_versions
from cinepulse.sources import manifest
from cinepulse.sources.versioned import query_id
from cinepulse.streaming.queries import DEFAULT_TRIGGER, _start



def _append_once(rows: DataFrame, path: str, writer: str, batch_id: int) -> int:
    """Add ``rows`` as one part unless this batch is there; returns the newest manifest's number."""
    spark = rows.sparkSession
    now = manifest.read_manifest(spark, path)
    if now.holds(writer, batch_id):
        return now.number
    folder = manifest.new_folder()
    rows.write.parquet(f"{path}/{folder}")

    def add(at: manifest.Manifest):
        return None if at.holds(writer, batch_id) else (at.parts | {f"{writer}-{batch_id}": folder}, at.marks | {writer: batch_id})

    return manifest.update(spark, path, add).number


def publish_changes(changes: DataFrame, path: str, writer: str, batch_id: int) -> int:
    """Append changes as one part; a batch that the log holds already is not added again.
    Returns the number of the newest manifest."""
    return _append_once(changes.select(*[F.col(f.name).cast(f.dataType) for f in CHANGE_SCHEMA]), path, writer, batch_id)


def read_history(spark: SparkSession, path: str, now: manifest.Manifest | None = None, events: DataFrame | None = None) -> DataFrame:
    """The versions in the log, or those of the movies that ``events`` name, if these are few."""
    changes = manifest.read_parts(spark, path, CHANGE_SCHEMA, now)
    return history(changes if events is None else changes_of(changes, events))


def start_versioned(
    events: DataFrame,
    changes_path: str,
    path: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append each batch, joined with the versions known when it runs, to the table at ``path``.

    A batch pins the newest manifest of the log, so a catalogue published while the query runs
    is seen from the next batch on (a plain stream-static join keeps the files of its start).
    ``catalog_number`` is that manifest: a change that arrives after events of its range leaves
    them as they were joined, and the number tells which rows to join again."""
    spark = events.sparkSession

    def write(batch: DataFrame, epoch_id: int) -> None:
        pinned = manifest.read_manifest(spark, changes_path)
        rows = join_versions(batch, read_history(spark, changes_path, pinned, batch))
        _append_once(rows.withColumn("catalog_number", F.lit(pinned.number)), path, query_id(batch), epoch_id)

    return _start(events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), trigger, query_name)


def read_versioned(spark: SparkSession, path: str, events_schema: T.StructType) -> DataFrame:
    empty = spark.createDataFrame([], events_schema)
    versions = history(spark.createDataFrame([], CHANGE_SCHEMA))
    schema = join_versions(empty, versions).withColumn("catalog_number", F.lit(0)).schema
    return manifest.read_parts(spark, path, schema)
