"""A catalogue that changes: every event joins the version valid at its own time.

The catalogue is a log of changes (movie, instant, attributes, deleted or not).
``history`` turns it into versions with a range [valid_from, valid_to);
of several changes of a movie at one instant the largest ``change_id`` wins. An event takes the
last version at or before its time. No version yet, a deleted movie, a NULL movie or a NULL
time give NULL attributes; no event is dropped or repeated.

A history under a checked size is broadcast. Otherwise events and versions are united and a
running window carries the last version along the time order: linear in both, however many
versions a movie has. A movie with more than ``HOT_ROWS`` events is spread over salts (events
by a hash of their columns, its versions copied to its salts); versions of all others, and
so nearly all of them, are shuffled once. Versions that end before the first event or begin
after the last are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinepulse.functions.joins import DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_SALT_BUCKETS, fits_broadcast

CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("change_id", T.LongType()),
        T.StructField("movie_id", T.StringType()),
        T.StructField("changed_at", T.TimestampType()),
        T.StructField("title", T.StringType()),
        T.StructField("catalog_genre", T.StringType()),
        T.StructField("deleted", T.BooleanType()),
    ]
)
ATTRIBUTES = ["change_id", "title", "catalog_genre"]
RANGE = ["valid_from", "valid_to"]
#: Events of one movie that a task takes; beyond it they are dealt over salts.
HOT_ROWS = 100_000
#: Movies up to which the changes of just these movies are read, by a broadcast of their ids.
NAMED_MOVIES = 100_000


def changes_of(changes: DataFrame, events: DataFrame, max_movies: int = NAMED_MOVIES) -> DataFrame:
    """``changes`` of the movies that ``events`` name; all changes if these movies are more
    than ``max_movies``. Both passes over ``events`` read one column, so it should be stored."""
    named = events.select("movie_id").filter(F.col("movie_id").isNotNull()).distinct()
    if named.limit(max_movies + 1).count() > max_movies:
        return changes
    return changes.join(F.broadcast(named), "movie_id", "left_semi").select(*changes.columns)


def history(changes: DataFrame) -> DataFrame:
    """movie_id, valid_from, valid_to (NULL: still valid), attributes, deleted. Changes
    without a movie or an instant are no versions."""
    known = changes.filter(F.col("movie_id").isNotNull() & F.col("changed_at").isNotNull())
    held = F.struct("change_id", *[c for c in CHANGE_SCHEMA.names if c not in ("change_id", "movie_id", "changed_at")])
    last = known.groupBy("movie_id", F.col("changed_at").alias("valid_from")).agg(F.max(held).alias("v"))
    valid_to = F.lead("valid_from").over(W.partitionBy("movie_id").orderBy("valid_from"))
    deleted = F.coalesce(F.col("v.deleted"), F.lit(False)).alias("deleted")
    return last.select("movie_id", "valid_from", valid_to.alias("valid_to"), *[f"v.{c}" for c in ATTRIBUTES], deleted)


def join_versions(
    events: DataFrame,
    versions: DataFrame,
    time_col: str = "event_time",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``events`` with the attributes and range of the version valid at ``time_col``; columns
    of equal names are replaced. Without a broadcast a first pass over ``events`` counts them
    by movie: their time range, and the movies of more than ``hot_rows`` events."""
    added = [*ATTRIBUTES, *RANGE]
    events = events.drop(*added)
    named = F.struct(*added)
    if fits_broadcast(versions, max_broadcast_bytes):
        live = versions.filter(~F.col("deleted")).select(F.col("movie_id").alias("_movie"), named.alias("_v"))
        at = F.col(time_col)
        valid = (at >= F.col("_v.valid_from")) & (F.col("_v.valid_to").isNull() | (at < F.col("_v.valid_to")))
        out = events.join(F.broadcast(live), (F.col("movie_id") == F.col("_movie")) & valid, "left")
        return out.select(*events.columns, *[F.col(f"_v.{c}").alias(c) for c in added])
    first, last, hot = _spread(events, time_col, salt_buckets, hot_rows)
    versions = versions.filter(
        (F.col("valid_from") <= F.timestamp_micros(F.lit(last))) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.timestamp_micros(F.lit(first))))
    )
    # Rows of events and of versions, in one order of time; a version comes before the events of its instant.
    rows = events.select(
        F.col("movie_id").alias("_movie"), F.xxhash64(*events.columns).alias("_salt"), F.col(time_col).alias("_at"), F.lit(1).alias("_kind"),
        F.struct(*events.columns).alias("_e"),
    )
    # A deleted version is a value too: it ends the one before it.
    marks = versions.select(
        F.col("movie_id").alias("_movie"), F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"),
        F.struct(F.col("deleted"), named.alias("v")).alias("_m"),
    )
    if hot is None:
        rows, marks = rows.withColumn("_salt", F.lit(0)), marks.withColumn("_salt", F.lit(0))
    else:
        salts = F.coalesce("_salts", F.lit(1))
        rows = rows.join(hot, "_movie", "left").withColumn("_salt", F.pmod("_salt", salts).cast("int")).drop("_salts")
        marks = marks.join(hot, "_movie", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    # Events without a movie or time have no version: they need not meet in one task.
    placed = F.col("_movie").isNotNull() & F.col("_at").isNotNull()
    run = W.partitionBy("_movie", "_salt").orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    both = rows.filter(placed).unionByName(marks, allowMissingColumns=True)
    joined = both.withColumn("_m", F.last("_m", ignorenulls=True).over(run)).filter("_kind = 1")
    value = F.when(~F.col("_m.deleted"), F.col("_m.v"))
    joined = joined.select("_e.*", *[value[c].alias(c) for c in added])
    return joined.unionByName(rows.filter(~placed).select("_e.*"), allowMissingColumns=True)


def _spread(events: DataFrame, time_col: str, salt_buckets: int, hot_rows: int) -> tuple[int | None, int | None, DataFrame | None]:
    """First and last time of the events that name a movie (microseconds), and the salts of
    each hot movie, marked for broadcast: at most one row per ``hot_rows`` events."""
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    by_movie = events.filter(F.col("movie_id").isNotNull() & micros.isNotNull()).groupBy("movie_id")
    busy = by_movie.agg(F.count(F.lit(1)).alias("n"), F.min(micros).alias("first"), F.max(micros).alias("last"))
    hot = F.collect_list(F.when(F.col("n") > hot_rows, F.struct("movie_id", "n"))).alias("hot")
    found = busy.agg(F.min("first").alias("first"), F.max("last").alias("last"), hot).first()
    salts = [(r.movie_id, min(salt_buckets, -(-r.n // hot_rows))) for r in found.hot]
    spread = F.broadcast(events.sparkSession.createDataFrame(salts, "_movie string, _salts int")) if salts else None
    return found.first, found.last, spread
