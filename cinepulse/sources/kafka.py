"""Kafka source and sink for the activity topic.

Needs the ``spark-sql-kafka`` connector on the classpath (not bundled with
PySpark); without it Spark reports ``Failed to find data source: kafka``. Tests
use the file stream in ``sources.files`` with the same ``value, timestamp`` shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the topic the event producer publishes to.
DEFAULT_TOPIC = "web_activity"


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = 1000,
    extra_options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming frame of the topic: value BINARY, timestamp TIMESTAMP (broker time)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (extra_options or {}).items():
        reader = reader.option(k, v)
    return reader.load().select("value", "timestamp")


def read_kafka_batch(spark: SparkSession, bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> DataFrame:
    """The retained topic as a batch frame (earliest to latest offsets)."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
        .select("value", "timestamp")
    )


def write_kafka(messages: DataFrame, bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Publish a batch frame with a ``value`` column (see ``operators.ingest.encode_events``)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save()


def write_kafka_stream(messages: DataFrame, bootstrap_servers: str, checkpoint: str, topic: str = DEFAULT_TOPIC, query_name: str | None = None):
    writer = (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()
