"""Lookup joins of a large fact side with a dimension of unknown size.

A dimension is broadcast only when the optimizer's size estimate of the pruned,
filtered side is below a bound; otherwise both sides are shuffled on the key plus a
deterministic salt, so that one hot key (a third of all rows, say) is spread over
``salt_buckets`` tasks instead of landing in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# In-memory rows are wider than compressed Parquet; scale the plan estimate by this.
SIZE_SAFETY_FACTOR = 8
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_SALT_BUCKETS = 16
SALT = "_salt"


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Optimizer estimate of ``df`` in bytes, or None when it is not available."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # Spark Connect or a plan without statistics
        return None


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    size = estimated_size_bytes(df)
    return size is not None and size * SIZE_SAFETY_FACTOR <= max_bytes


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
    salt_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffle join with every dimension row copied to ``salt_buckets`` salts.

    The fact salt is a hash of its own columns, so a retried task recomputes the
    same salt (a random salt would move rows between reducers on retry). Copying
    the dimension ``salt_buckets`` times is the price; the fact side, far larger, is
    shuffled once, and no reducer receives more than about 1/``salt_buckets`` of
    a hot key's rows.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted join keeps the fact side on the left, not {how!r}")
    cols = list(salt_cols) if salt_cols else fact.columns
    salted_fact = fact.withColumn(SALT, F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salt_buckets)))
    salted_dim = dim.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long"))))
    return salted_fact.join(salted_dim, [*on, SALT], how).drop(SALT)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
    salt_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Join a fact with a dimension: checked broadcast, else salted shuffle join."""
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(dim, max_broadcast_bytes):
        return fact.join(F.broadcast(dim), keys, how)
    return salted_join(fact, dim, keys, how, salt_buckets, salt_cols)


def join_bounded(small: DataFrame, other: DataFrame, on: Sequence[str] | str | Column, how: str = "inner") -> DataFrame:
    """Join where ``small`` has a proven row bound (the output of ``limit(k)``)."""
    return F.broadcast(small).join(other, on, how)
