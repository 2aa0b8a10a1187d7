"""The live snapshot table: replaced whole on each refresh, read whole by clients.

Each refresh is a new version of a versioned table (``sources.versioned``) holding one
Parquet file (the snapshot is at most k genres + k movies, already bounded by
``limit``): a reader sees the previous snapshot or the new one, never a half-written
table.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinepulse import schema as S
from cinepulse.operators.live import trending_snapshot, trending_snapshot_nested
from cinepulse.sources.versioned import read_latest, write_version


def write_snapshot(snapshot: DataFrame, path: str, version: int | None = None, keep: int = 3) -> str:
    """Publish ``snapshot`` as a new one-file version (default: epoch milliseconds)."""
    version = int(time.time() * 1000) if version is None else int(version)
    return write_version(snapshot, path, version, keep, single_file=True)


def publish_live_snapshot(
    events: DataFrame,
    path: str,
    as_of=None,
    window: str = S.DEFAULT_TRAILING,
    k_genres: int = S.TOP_LIVE_GENRES,
    k_movies: int = S.TOP_LIVE_MOVIES,
    nested: bool = False,
) -> str:
    """One refresh of the live view: compute the snapshot and publish it.

    Long form (section, position, key, score) by default; ``nested`` publishes the
    one-row response shape (``trending_genres``, ``movie_scores`` arrays with the
    movie details) that a reader can serve as is.

    For a running service pass ``as_of=F.localtimestamp()`` (server clock, TIMESTAMP_NTZ)
    and a lake read restricted to the last ``dt`` values, so each refresh scans only
    the partitions that can hold rows of the trailing window.
    """
    build = trending_snapshot_nested if nested else trending_snapshot
    return write_snapshot(build(events, as_of, window, k_genres, k_movies), path)


def read_snapshot(spark: SparkSession, path: str, section: str | None = None) -> DataFrame:
    """The newest snapshot; for the long form optionally one section
    (``trending_genres`` / ``movie_scores``)."""
    df = read_latest(spark, path)
    return df if section is None else df.filter(F.col("section") == F.lit(section))
