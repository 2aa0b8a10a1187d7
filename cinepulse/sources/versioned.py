"""Tables replaced whole: each replacement is a new ``version=<n>`` folder.

A version counts once its commit marker (``_SUCCESS``) exists. Readers take the newest
committed version, so they see the previous one or the new one, never a half-written
table, and an empty result is a version like any other. Streaming batches are not
ordered by their batch id, which starts anew with a new checkpoint: a batch is always
published as the next version, and a mark with the query's id and the batch id keeps
a replayed batch from being published again. Versions beyond ``keep`` are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VERSION = "version"


def _listing(spark: SparkSession, path: str):
    """Hadoop file system of ``path`` and its versions: number -> names in the folder."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[int, set[str]] = {}
    if fs.exists(root):
        for st in fs.listStatus(root):
            name, _, number = st.getPath().getName().partition("=")
            if name == VERSION and number.isdigit():
                found[int(number)] = {f.getPath().getName() for f in fs.listStatus(st.getPath())}
    return fs, found


def _committed(found: dict[int, set[str]]) -> list[int]:
    return sorted(v for v, names in found.items() if "_SUCCESS" in names)


def prune_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the newest ``keep`` committed versions and those older than them."""
    if keep <= 0:
        return
    fs, found = _listing(spark, path)
    kept = _committed(found)[-keep:]
    for v in found:
        if kept and v < kept[0]:
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}={v}"), True)


def write_version(df: DataFrame, path: str, version: int, keep: int = 2, single_file: bool = False) -> str:
    """Publish ``df`` as version ``version`` of the table at ``path``."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").parquet(f"{path}/{VERSION}={int(version)}")
    prune_versions(df.sparkSession, path, keep)
    return path


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version of the table."""
    committed = _committed(_listing(spark, path)[1])
    if not committed:
        raise FileNotFoundError(f"no committed version at {path}")
    return spark.read.parquet(f"{path}/{VERSION}={committed[-1]}")


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query whose batch this is; it lives as long as its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def merge_each_batch(path: str, merge, keep: int = 2):
    """``foreachBatch`` function: ``merge(newest version or None, batch)`` becomes the next
    version. A batch with a published mark is left out; a batch that failed between its version
    and its mark is merged again, so ``merge`` must not change by a second merge."""

    def publish(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        committed = _committed(_listing(spark, path)[1])
        held = spark.read.schema(batch.schema).parquet(f"{path}/{VERSION}={committed[-1]}") if committed else None
        publish_each_batch(path, keep)(merge(held, batch), epoch_id)

    return publish


def publish_each_batch(path: str, keep: int = 2):
    """``foreachBatch`` function: each trigger's full result becomes the next version."""

    def publish(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        mark = f"_batch-{query_id(batch)}-{epoch_id}"
        fs, found = _listing(spark, path)
        if any(mark in found[v] for v in _committed(found)):
            return
        version = max(found, default=-1) + 1
        write_version(batch, path, version, keep)
        fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}={version}/{mark}")).close()

    return publish
