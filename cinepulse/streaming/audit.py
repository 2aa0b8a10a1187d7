"""Audit of streamed state: a checkpoint's state, read back and held against a batch run.

The state data source reads the keys and aggregation buffers of a stateful operator from a
query's checkpoint, as of a batch. ``compare`` puts them beside the same aggregate over the
events that the query has read, and returns the keys that do not agree: one grouping by key,
so a NULL key compares like any other, no side is broadcast and a repeated key shows up as
one. An empty result is a clean audit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse.streaming.user_state import KEY, user_state

MISSING, UNEXPECTED, DIFFERENT, REPEATED = "missing", "unexpected", "different", "repeated"


def read_state(spark: SparkSession, checkpoint: str, operator_id: int = 0, batch_id: int | None = None) -> DataFrame:
    """partition_id, key, value of a stateful operator (default: after the last committed batch)."""
    reader = spark.read.format("statestore").option("operatorId", str(operator_id))
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    return reader.load(checkpoint).select("partition_id", "key", "value")


def compare(found: DataFrame, expected: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys on which ``found`` and ``expected`` differ: keys, problem, found, expected (structs
    of the values, NULL where the key is absent)."""
    both = found.select(*keys, *values, F.lit(True).alias("_found")).unionByName(expected.select(*keys, *values, F.lit(False).alias("_found")))

    def side(of: Column) -> tuple[Column, Column]:
        return F.count(F.when(of, F.lit(1))), F.max(F.when(of, F.struct(*values)))

    (n_found, v_found), (n_expected, v_expected) = side(F.col("_found")), side(~F.col("_found"))
    grouped = both.groupBy(*keys).agg(n_found.alias("n"), n_expected.alias("m"), v_found.alias("found"), v_expected.alias("expected"))
    problem = (
        F.when(F.col("n") == 0, F.lit(MISSING))
        .when(F.col("m") == 0, F.lit(UNEXPECTED))
        .when((F.col("n") > 1) | (F.col("m") > 1), F.lit(REPEATED))
        .when(~F.col("found").eqNullSafe(F.col("expected")), F.lit(DIFFERENT))
    )
    return grouped.withColumn("problem", problem).filter("problem is not null").select(*keys, "problem", "found", "expected")


def streamed_user_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The rows of ``user_state`` as its checkpoint holds them. The buffers are, in order: the
    value and the order of ``max_by``, and the maximum of the likes."""
    state = read_state(spark, checkpoint, 0, batch_id)
    fields = state.schema["value"].dataType.names
    at = lambda struct, name: F.col(struct).getField(name)
    names = state.schema["key"].dataType.names
    return state.select(
        *[at("key", n).alias(k) for n, k in zip(names, KEY)], at("value", fields[0]).cast("int").alias("rating_value"), at("value", fields[-1]).alias("liked")
    )


def audit_user_state(spark: SparkSession, checkpoint: str, events: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Keys whose streamed last rating or like differs from a batch run over ``events``, which
    must be the events that the query has read by that batch."""
    return compare(streamed_user_state(spark, checkpoint, batch_id), user_state(events), KEY, ["rating_value", "liked"])


def audit_user_table(table: DataFrame, events: DataFrame) -> DataFrame:
    """The same for the published table (``user_state.read_user_state``)."""
    return compare(table, user_state(events), KEY, ["rating_value", "liked"])
