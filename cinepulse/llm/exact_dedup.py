"""Exact dedup as a stateful stream.

The rows' digests, ids and places (file, row) flow through a streaming aggregation
whose keyed state never expires and lives on disk (RocksDB store, checkpointed in
the shared folder): per digest it retains the digest, the id of the row that stays
and its content locator. Running again on the same ``work`` folder adds only the
new rows to that state. Digests that were hit more than once are then checked on
the full bytes; texts that only share a digest are told apart again.

Defined results: a NULL text equals the empty text; of equal texts the row with the
largest id stays (NULL ids are smallest), among rows that repeat id and text the
one with the last place; an empty table gives an empty result; columns other than
the id and the text are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse.llm.common import located, small_side, staged, stored, text_or_empty
from cinepulse.session import fresh_path

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # A store is closed with its task. Else an executor keeps those of all its partitions, and of
    # runs that have ended, open until a maintenance pass: memory by partitions, not by tasks.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def _state_conf(spark: SparkSession) -> Iterator[None]:
    """``STATE_CONF`` for what writes or reads the state meanwhile."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _advance(spark: SparkSession, source: str, schema, state: str, files_per_trigger: int | None) -> None:
    """Run the stream over the files that the state has not seen yet."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    keyed = (
        reader.parquet(source)
        .groupBy("digest")
        .agg(F.max(F.struct("id", "loc_file", "loc_row")).alias("keeper"), F.count(F.lit(1)).alias("n"))
    )
    with _state_conf(spark):
        query = (
            keyed.writeStream.format("noop").outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """The retained state: digest, keeper (id, loc_file, loc_row), n."""
    return spark.read.format("statestore").load(state).select("key.digest", F.col("value.max").alias("keeper"), F.col("value.count").alias("n"))


def decisions(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    work: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, digest, loc_file, loc_row, keep_id, group_size, kept.

    ``work``: folder of the stream's input and state. With a fixed one the operator is
    incremental: pass the whole table again, and only the rows at places that earlier
    runs have not seen go through the stream.
    """
    docs, text = stored(spark, docs), text_or_empty(text_col)
    seen = located(docs, F.col(id_col).alias("id"), digest(text).alias("digest"))
    if work:
        seen.limit(0).write.mode("append").parquet(f"{work}/in")
        known = spark.read.schema(seen.schema).parquet(f"{work}/in").select("loc_file", "loc_row")
        seen = seen.join(known, ["loc_file", "loc_row"], "left_anti").select(*seen.columns)
    work = work or fresh_path(spark, "exact-dedup")
    source, state = f"{work}/in", f"{work}/state"
    seen.write.mode("append").parquet(source)
    rows = spark.read.schema(seen.schema).parquet(source)
    _advance(spark, source, seen.schema, state, files_per_trigger)
    if rows.isEmpty():
        return rows.withColumns({"keep_id": F.col("id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})

    with _state_conf(spark):
        hits = staged(spark, read_state(spark, state).filter("n > 1"), "exact-dedup-hits")
    # Full bytes of every row whose digest was hit: one smallest and one largest text
    # per digest, combined before the shuffle; they are equal if all texts are.
    full = located(docs, F.col(id_col).alias("id"), text.alias("text"), digest(text).alias("digest"))
    full = full.join(small_side(hits.select("digest")), "digest", "left_semi")
    extremes = full.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    clashes = staged(spark, extremes.filter("low != high").select("digest"), "exact-dedup-clashes")

    place = ["loc_file", "loc_row"]
    found = rows.join(small_side(hits), "digest", "left")
    if clashes.isEmpty():
        return _decide(found)
    apart = full.join(small_side(clashes), "digest", "left_semi")
    classes = apart.groupBy("digest", "text").agg(F.max(F.struct("id", *place)).alias("keeper"), F.count(F.lit(1)).alias("n"))
    apart = _decide(apart.join(classes, ["digest", "text"]))
    return _decide(found.join(small_side(clashes), "digest", "left_anti")).unionByName(apart)


def _decide(found: DataFrame) -> DataFrame:
    """``found``: rows with the keeper and size of their group, NULL for a group of one."""
    alone = F.col("n").isNull()
    return found.select(
        "id",
        "digest",
        "loc_file",
        "loc_row",
        F.when(alone, F.col("id")).otherwise(F.col("keeper.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce((F.col("keeper.loc_file") == F.col("loc_file")) & (F.col("keeper.loc_row") == F.col("loc_row")), F.lit(True)).alias("kept"),
    )


def drop_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that an equal text replaces; columns unchanged."""
    docs = stored(spark, docs)
    dropped = staged(spark, decisions(spark, docs, id_col, text_col).filter("not kept").select("loc_file", "loc_row"), "exact-dedup-dropped")
    cols = docs.columns
    rows = located(docs, F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc"))
    return rows.join(small_side(dropped), ["loc_file", "loc_row"], "left_anti").select("doc.*")
