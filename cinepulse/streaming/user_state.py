"""Per-user state as a stream: the last rating and the liked set, kept for ever.

The aggregate by (user, movie) has no watermark: its keys never expire, so the state is
kept in the RocksDB store, on disk with a bounded share of memory. Each batch emits the keys
that changed, with their whole present value, and ``foreachBatch`` upserts them into a
table of ``buckets`` parts by a hash of the key: only the parts that hold a changed key are
written anew, next to the old ones, and one manifest swap publishes them together. A batch that
is repeated after a failure finds its mark in the manifest and writes nothing; a new
checkpoint is another writer, whose values replace those of equal keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cinepulse import schema as S
from cinepulse.functions.expressions import is_action
from cinepulse.sources import manifest
from cinepulse.sources.versioned import query_id
from cinepulse.streaming.queries import DEFAULT_TRIGGER, _start

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DEFAULT_BUCKETS = 64
KEY = ["user_id", "movie_id"]
STATE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("movie_id", T.StringType()),
        T.StructField("rating_value", T.IntegerType()),
        T.StructField("liked", T.BooleanType()),
    ]
)


def user_state(events: DataFrame, time_col: str = "event_time") -> DataFrame:
    """user_id, movie_id, rating_value (last one; NULL if never rated), liked: batch or stream.
    Of ratings at one instant the larger ``event_id`` (if there is one) wins, then the higher rating."""
    rated = is_action(S.ACTION_RATE) & F.col("rating_value").isNotNull()
    order = F.struct(*[F.col(c) for c in (time_col, "event_id") if c in events.columns], F.col("rating_value"))
    kept = events.filter(rated | is_action(S.ACTION_LIKE))
    return kept.groupBy(*KEY).agg(
        F.max_by("rating_value", F.when(rated, order)).cast("int").alias("rating_value"),
        F.max(is_action(S.ACTION_LIKE)).alias("liked"),
    )


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def upsert(changed: DataFrame, path: str, writer: str, batch_id: int, buckets: int = DEFAULT_BUCKETS) -> list[int]:
    """Put the rows of ``changed`` (one a key) in place of those with equal keys; returns the
    parts that were written."""
    spark = changed.sparkSession
    now = manifest.read_manifest(spark, path)
    if now.holds(writer, batch_id):
        return []
    fresh = changed.withColumn("bucket", _bucket(buckets)).persist()
    try:
        touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())  # at most ``buckets``
        parts = dict(now.parts)
        if touched:
            held = manifest.read_parts(spark, path, STATE_SCHEMA, now, [str(b) for b in touched]).withColumn("bucket", _bucket(buckets))
            rank = F.struct("fresh", "rating_value", "liked")
            both = fresh.withColumn("fresh", F.lit(1)).unionByName(held.withColumn("fresh", F.lit(0)))
            # Both sides of a key meet in the shuffle by bucket: no join, and the writer's layout.
            rows = both.repartition("bucket").groupBy("bucket", *KEY).agg(F.max(rank).alias("r"))
            folder = manifest.new_folder()
            rows.select("bucket", *KEY, "r.rating_value", "r.liked").write.partitionBy("bucket").parquet(f"{path}/{folder}")
            parts |= {str(b): f"{folder}/bucket={b}" for b in touched}
        manifest.commit(spark, path, manifest.Manifest(now.number + 1, parts, now.marks | {writer: batch_id}))
    finally:
        fresh.unpersist()
    return touched


def start_user_state(
    events: DataFrame,
    path: str,
    checkpoint: str,
    buckets: int = DEFAULT_BUCKETS,
    trigger: str | None = DEFAULT_TRIGGER,
    query_name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep the table at ``path`` up to date from a stream of events."""
    spark = events.sparkSession

    def write(batch: DataFrame, epoch_id: int) -> None:
        upsert(batch, path, query_id(batch), epoch_id, buckets)

    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # copied by the query at its start
    try:
        writer = user_state(events).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
        return _start(writer, trigger, query_name, state_partitions)
    finally:
        spark.conf.set(PROVIDER, old) if old else spark.conf.unset(PROVIDER)


def read_user_state(spark: SparkSession, path: str) -> DataFrame:
    return manifest.read_parts(spark, path, STATE_SCHEMA)


def latest_ratings(state: DataFrame) -> DataFrame:
    return state.filter("rating_value is not null").select(*KEY, "rating_value")


def liked_pairs(state: DataFrame) -> DataFrame:
    return state.filter("liked").select(*KEY)
