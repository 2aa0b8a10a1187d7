"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All run over the whole driver tables through the adapter views in
``sources.adapter``. Timestamps in results are TIMESTAMP_NTZ (UTC wall time).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinepulse import schema as S
from cinepulse.functions.clock import iso_naive_text, resolve_as_of
from cinepulse.operators import catalog as cat
from cinepulse.operators import catalog_history, day_partials, ingest, live, reports, state, time_index, windowed
from cinepulse.session import ensure_utc, fresh_path
from cinepulse.sources import adapter, files, lake, snapshot
from cinepulse.sources.versioned import read_latest
from cinepulse.streaming import audit, catalog_stream, fanout, ranked, user_state
from cinepulse.streaming import queries as streams

# Parameters of the registered queries (see README, "Registered queries").
TREND_WINDOW = "5 minutes"  # the reference's tumbling window
DAY_WINDOW = "1 day"
LIVE_TRAILING = "1 day"  # sf0.01 has about one event per 4 minutes
IDLE = dt.timedelta(days=2)  # longer than the trailing window
MALFORMED_EVERY = 97
ODD_EVERY = 31  # remainders 1 to 7 get other JSON types (ingest.ODD_PAYLOADS)
STREAM_WATERMARK = "10 minutes"
SLIDING_WINDOW = ("1 hour", "15 minutes")
LIVE_BUCKET = "1 minute"
LAKE_DAY = "2024-01-15"
LAKE_ACTION = "play"
CATALOG_GENRE = "SMALL"
REPLAY_BATCHES = 4  # micro-batches of a replay: state is carried from one to the next
INSTANTS = 20
#: Steps between the instants of the indexed live views, and between their trailing windows.
INSTANT_STEP = dt.timedelta(hours=37, minutes=11, microseconds=7_123_457)
WINDOW_STEP = dt.timedelta(hours=5, minutes=3, microseconds=777_001)
USER_BUCKETS = 16
LATE_FROM = "2024-01-20"  # ratings from here on reach the lake after the first refresh of the reports
#: Versions of each movie: changed every ten days from here on, at an hour of its key.
CATALOG_START, CATALOG_VERSIONS, CATALOG_STEP_DAYS = "2024-01-01", 3, 10
STREAM_TIMEOUT_S = 900
STATE_PARTITIONS = 8  # state of these views is small (windows x genres/movies)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return adapter.activity(spark, sf_dir)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def _messages(spark: SparkSession, sf_dir: str, malformed_every: int | None = MALFORMED_EVERY, odd_every: int | None = None) -> DataFrame:
    return ingest.to_messages(_events(spark, sf_dir), malformed_every, odd_every=odd_every)


# --- ingest -----------------------------------------------------------------


def q_parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode the topic messages; every 97th payload is broken and stays an all-NULL row."""
    return _ntz(ingest.parse_events(_messages(spark, sf_dir)), "event_time")


def q_validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted messages (some with odd JSON types), payload time replaced by
    the intake instant."""
    return _ntz(ingest.validate_events(_messages(spark, sf_dir, odd_every=ODD_EVERY)), "event_time")


def q_quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages per reason."""
    return ingest.quarantine_counts(_messages(spark, sf_dir, odd_every=ODD_EVERY))


def q_intake_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass intake (accepted and quarantined together), rows per status and reason."""
    intake = ingest.intake(_messages(spark, sf_dir, odd_every=ODD_EVERY))
    return intake.groupBy("status", F.col("reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def q_normalize_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with `Z`, zone-less, empty, junk, time or year only, padded; rows
    that are no ISO instant drop out, whatever the day of the run."""
    ev = _events(spark, sf_dir)
    text = (
        F.when(F.col("event_id") % 4 == 0, F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(F.col("event_id") % 8 == 1, iso_naive_text("event_time"))
        .when(F.col("event_id") % 8 == 2, F.lit(""))
        .when(F.col("event_id") % 8 == 3, F.lit("not-a-time"))
        .when(F.col("event_id") % 8 == 5, F.date_format("event_time", "HH:mm:ss"))
        .when(F.col("event_id") % 8 == 6, F.date_format("event_time", "yyyy"))
        .otherwise(F.concat(F.lit(" "), iso_naive_text("event_time")))
    )
    raw = ev.select("event_id", text.alias("timestamp"))
    return ingest.normalize_timestamps(raw, "timestamp", "event_time")


def q_publish_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON payloads with NULL fields written, decoded back."""
    ev = _events(spark, sf_dir).withColumn("timestamp", iso_naive_text("event_time"))
    published = ingest.encode_events(ev)
    text = F.col("value").cast("string")
    back = published.select(F.from_json(text, S.EVENT_SCHEMA).alias("d"), F.size(F.json_object_keys(text)).alias("n_fields"))
    return back.select("d.*", "n_fields")


# --- windowed ---------------------------------------------------------------


def q_trending_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genre counts per 5-minute window."""
    return windowed.trending_genres(_events(spark, sf_dir), TREND_WINDOW)


def q_trending_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 (window, genre) rows."""
    return windowed.calculate_trending_genres(_events(spark, sf_dir), TREND_WINDOW, 10)


def q_top_genre_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most active genre of each day."""
    return windowed.top_genre_per_window(windowed.trending_genres(_events(spark, sf_dir), DAY_WINDOW))


def q_engagement_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement per (5-minute window, movie, genre)."""
    return windowed.engagement_scores(_events(spark, sf_dir), TREND_WINDOW)


def q_engagement_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 engagement rows."""
    return windowed.calculate_engagement_score(_events(spark, sf_dir), TREND_WINDOW, 20)


# --- live -------------------------------------------------------------------


def _live(spark: SparkSession, sf_dir: str):
    """Events and the snapshot instant (max event time, resolved to a literal so the
    trailing predicate is pushed into the Parquet scan)."""
    ev = _events(spark, sf_dir)
    return ev, resolve_as_of(ev)


def _at_minute(spark: SparkSession, sf_dir: str):
    """Events and the newest event time floored to the minute (None without events)."""
    ev, newest = _live(spark, sf_dir)
    return ev, newest and newest.replace(second=0, microsecond=0)


def q_live_trending_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live genre top 5 over the trailing day."""
    ev, as_of = _live(spark, sf_dir)
    return live.live_trending_genres(ev, as_of, LIVE_TRAILING)


def q_live_movie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live movie top 10 over the trailing day."""
    ev, as_of = _live(spark, sf_dir)
    return live.live_movie_scores(ev, as_of, LIVE_TRAILING)


def q_trending_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both live lists in long form."""
    ev, as_of = _live(spark, sf_dir)
    return live.trending_snapshot(ev, as_of, LIVE_TRAILING)


def q_health_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events processed and events in the trailing window."""
    # Counts every row anyway (no filter to push), so the instant stays a subquery
    # evaluated inside the same query instead of a separate job.
    return live.health_counts(_events(spark, sf_dir), None, LIVE_TRAILING)


def q_genre_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend cards with share of the top score."""
    ev, as_of = _live(spark, sf_dir)
    return cat.genre_share(ev, as_of, LIVE_TRAILING)


def q_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 live movies joined with the catalogue."""
    ev, as_of = _live(spark, sf_dir)
    return cat.leaderboard(ev, adapter.catalog(spark, sf_dir), as_of, LIVE_TRAILING)


def q_headline_movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue row of the top live movie, else the most liked."""
    ev, as_of = _live(spark, sf_dir)
    return cat.headline_movie(ev, adapter.catalog(spark, sf_dir), as_of, LIVE_TRAILING)


def q_live_genres_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live genre top-5 from one-minute buckets at a minute boundary (max event
    time floored to the minute): equal to the raw-event view at that instant."""
    ev, as_of = _at_minute(spark, sf_dir)
    return live.live_trending_genres_from_buckets(live.genre_buckets(ev, LIVE_BUCKET), as_of, LIVE_TRAILING)


def q_live_movie_scores_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live movie top-10 from one-minute buckets at a minute boundary."""
    ev, as_of = _at_minute(spark, sf_dir)
    return live.live_movie_scores_from_buckets(live.movie_buckets(ev, LIVE_BUCKET), as_of, LIVE_TRAILING)


def q_trending_snapshot_from_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both live lists in long form from one-minute buckets at a minute boundary."""
    ev, as_of = _at_minute(spark, sf_dir)
    return live.trending_snapshot_from_buckets(live.genre_buckets(ev, LIVE_BUCKET), live.movie_buckets(ev, LIVE_BUCKET), as_of, LIVE_TRAILING)


def q_snapshot_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the snapshot published at the newest event and again after two idle days;
    the table then holds the idle window's empty lists, not the older ones."""
    ev, as_of = _live(spark, sf_dir)
    path = fresh_path(spark, "snapshot")
    snapshot.publish_live_snapshot(ev, path, as_of, LIVE_TRAILING)
    snapshot.publish_live_snapshot(ev, path, as_of and as_of + IDLE, LIVE_TRAILING)
    return snapshot.read_snapshot(spark, path)


def q_live_genre_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute (start, end] buckets of live genre counts."""
    return live.genre_buckets(_events(spark, sf_dir), LIVE_BUCKET).select("bucket_start", "genre", "score")


# --- catalogue --------------------------------------------------------------


def q_catalog_by_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows of one genre."""
    return cat.by_genre(adapter.catalog(spark, sf_dir), CATALOG_GENRE)


def q_catalog_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `All` selector (no filter)."""
    return cat.by_genre(adapter.catalog(spark, sf_dir), "All")


def q_catalog_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total likes and views."""
    return cat.totals(adapter.catalog(spark, sf_dir))


def q_catalog_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most liked, most viewed, highest rated (ties: last row)."""
    return cat.extremes(adapter.catalog(spark, sf_dir))


def q_catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies and genres."""
    return cat.counts(adapter.catalog(spark, sf_dir))


# --- state, reports, lake ---------------------------------------------------


def q_latest_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last rating per (user, movie)."""
    return state.latest_ratings(_events(spark, sf_dir))


def q_liked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, movie) pairs with a like."""
    return state.liked_pairs(_events(spark, sf_dir))


def q_daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement per day, movie and genre."""
    return reports.daily_report(_events(spark, sf_dir))


def q_monthly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement per month, movie and genre."""
    return reports.monthly_report(_events(spark, sf_dir))


def _landed(spark: SparkSession, sf_dir: str, *selection) -> DataFrame:
    """All events written to a lake, and the selected part of it read back."""
    ev = _events(spark, sf_dir)
    path = lake.write_lake(ev, fresh_path(spark, "lake"))
    return lake.read_lake(spark, path, *selection, schema=lake.stored_schema(ev))


def q_daily_report_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily report built from the landed lake (all of it) instead of the events."""
    return reports.daily_report(_landed(spark, sf_dir))


def _refreshed(spark: SparkSession, sf_dir: str) -> str:
    """Report partials of the whole lake, refreshed before and after the late ratings arrive."""
    ev = _events(spark, sf_dir)
    path, out = fresh_path(spark, "lake"), fresh_path(spark, "day-partials")
    late = F.coalesce((F.col("action") == S.ACTION_RATE) & (F.col("event_time") >= F.lit(LATE_FROM).cast("timestamp")), F.lit(False))
    for part in (ev.filter(~late), ev.filter(late)):
        lake.write_lake(part, path)
        day_partials.refresh(spark, path, out, lake.stored_schema(ev))
    return out


def q_daily_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily report from mergeable day partials, after a refresh that recomputes
    only the days with late files."""
    return day_partials.daily_report(spark, _refreshed(spark, sf_dir))


def q_monthly_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly report summed from the day partials."""
    return day_partials.monthly_report(spark, _refreshed(spark, sf_dir))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of catalogue changes: versions of every movie, the last one of some a deletion."""
    version = F.explode(F.sequence(F.lit(0), F.lit(CATALOG_VERSIONS - 1))).alias("v")
    rows = adapter.catalog(spark, sf_dir).select("pos", "movie_id", "title", "genre", version)
    hours = (F.col("v") * CATALOG_STEP_DAYS + F.col("pos") % 7) * 24 + F.col("pos") % 24
    return rows.select(
        (F.col("pos") * CATALOG_VERSIONS + F.col("v")).alias("change_id"),
        "movie_id",
        (F.lit(CATALOG_START).cast("timestamp") + F.make_dt_interval(hours=hours.cast("int"))).alias("changed_at"),
        F.concat("title", F.lit(" v"), F.col("v").cast("string")).alias("title"),
        F.col("genre").alias("catalog_genre"),
        ((F.col("v") == CATALOG_VERSIONS - 1) & (F.col("pos") % 11 == 0)).alias("deleted"),
    )


_VERSIONED = ["event_id", "movie_id", *catalog_history.ATTRIBUTES, *catalog_history.RANGE]


def q_catalog_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the catalogue version valid at its time."""
    versions = catalog_history.history(_changes(spark, sf_dir))
    return _ntz(catalog_history.join_versions(_events(spark, sf_dir), versions).select(*_VERSIONED), *catalog_history.RANGE)


def q_lake_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake written by (dt, action part), rows per day and action read back."""
    return lake.partition_counts(_landed(spark, sf_dir))


def q_lake_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One (dt, action) partition read back with partition pruning."""
    return _landed(spark, sf_dir, LAKE_DAY, LAKE_DAY, [LAKE_ACTION], ["movie_id", "event_time"])


# --- streaming --------------------------------------------------------------


def _stream_source(spark: SparkSession, sf_dir: str) -> dict:
    """The activity messages as files in time order (their number follows the rows), for
    ``read_message_stream`` in ``REPLAY_BATCHES`` micro-batches."""
    path = fresh_path(spark, "messages")
    n = files.write_replay(_messages(spark, sf_dir, malformed_every=None), path)
    return {"path": path, "max_files_per_trigger": -(-n // REPLAY_BATCHES)}


def _message_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_events(files.read_message_stream(spark, **_stream_source(spark, sf_dir)))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed events themselves (with their ids) as a stream in time order. They are stored
    once first: the replay reads its rows three times (to count, to sample, to write)."""
    ev, path, stored = _events(spark, sf_dir), fresh_path(spark, "events"), fresh_path(spark, "parsed")
    ev.write.parquet(stored)
    n = files.write_replay(spark.read.schema(ev.schema).parquet(stored), path, "event_time")
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", str(-(-n // REPLAY_BATCHES))).parquet(path)


def _run(query) -> None:
    streams.await_all([query], STREAM_TIMEOUT_S)


def _appended(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """A sink of ``rows`` partitioned by ``dt``, read with its declared schema: a stream
    without any closed window has written no file to take it from."""
    schema = T.StructType([*rows.schema.fields, T.StructField("dt", T.DateType())])
    return spark.read.schema(schema).parquet(path).drop("dt")


def q_stream_trending_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend as a complete-mode stream over several micro-batches."""
    events = _message_events(spark, sf_dir)
    out, ckpt = fresh_path(spark, "trending"), fresh_path(spark, "ckpt-trending")
    _run(streams.start_trending(events, out, ckpt, TREND_WINDOW, trigger="availableNow", state_partitions=STATE_PARTITIONS))
    return _ntz(read_latest(spark, out), "window_start", "window_end")


def q_stream_engagement_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement as an append-mode stream with a watermark (closed days)."""
    events = _message_events(spark, sf_dir)
    out, ckpt = fresh_path(spark, "engagement"), fresh_path(spark, "ckpt-engagement")
    _run(
        streams.start_engagement(events, out, ckpt, DAY_WINDOW, STREAM_WATERMARK, trigger="availableNow", state_partitions=STATE_PARTITIONS)
    )
    return _ntz(_appended(spark, out, windowed.engagement_scores(events, DAY_WINDOW)), "window_start", "window_end")


def _top_stream(spark: SparkSession, sf_dir: str, start, name: str) -> DataFrame:
    events = _message_events(spark, sf_dir)
    out, ckpt = fresh_path(spark, name), fresh_path(spark, f"ckpt-{name}")
    _run(start(events, ckpt, out, TREND_WINDOW, trigger="availableNow", state_partitions=STATE_PARTITIONS))
    return _ntz(read_latest(spark, out), "window_start", "window_end")


def q_stream_top_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranked trend view of the streaming job (top 10, complete mode)."""
    return _top_stream(spark, sf_dir, streams.start_top_trending, "top-trending")


def q_stream_top_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranked engagement view of the streaming job (top 20, complete mode)."""
    return _top_stream(spark, sf_dir, streams.start_top_engagement, "top-engagement")


def q_stream_live_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live genres over sliding windows (1 hour every 15 minutes), streamed."""
    events = _message_events(spark, sf_dir)
    out, ckpt = fresh_path(spark, "live-genres"), fresh_path(spark, "ckpt-live-genres")
    _run(streams.start_live_genres(events, out, ckpt, *SLIDING_WINDOW, trigger="availableNow", state_partitions=STATE_PARTITIONS))
    return _ntz(read_latest(spark, out), "window_start", "window_end")


def q_stream_live_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live genre buckets as an append-mode stream (closed buckets)."""
    events = _message_events(spark, sf_dir)
    out, ckpt = fresh_path(spark, "live-buckets"), fresh_path(spark, "ckpt-live-buckets")
    queries = streams.start_live_buckets(
        events, out, ckpt, LIVE_BUCKET, STREAM_WATERMARK, trigger="availableNow", state_partitions=STATE_PARTITIONS
    )
    streams.await_all(queries, STREAM_TIMEOUT_S)
    genres = _appended(spark, f"{out}/genres", live.genre_buckets(events, LIVE_BUCKET))
    return _ntz(genres.select("bucket_start", "genre", "score"), "bucket_start")


def q_stream_raw_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lake sink, rows per partition read back."""
    events = _message_events(spark, sf_dir)
    path, ckpt = fresh_path(spark, "stream-lake"), fresh_path(spark, "ckpt-stream-lake")
    _run(streams.start_raw_lake(events, path, ckpt, trigger="availableNow"))
    return lake.partition_counts(lake.read_lake(spark, path, schema=lake.stored_schema(events)))


def _instants(newest: dt.datetime | None) -> list[tuple[dt.datetime, dt.timedelta]]:
    """Instants between bucket edges, each with a trailing window of its own length."""
    return [] if newest is None else [(newest - i * INSTANT_STEP, dt.timedelta(days=1) + i * WINDOW_STEP) for i in range(INSTANTS)]


def _indexed(spark: SparkSession, sf_dir: str) -> tuple[str, list]:
    ev = _events(spark, sf_dir)
    path = time_index.write_index(ev, fresh_path(spark, "time-index"))
    return path, _instants(resolve_as_of(spark.read.parquet(f"{path}/{time_index.RAW}")))


def q_live_genres_at_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live genre lists of 20 instants and window lengths, exact, from the time index."""
    path, instants = _indexed(spark, sf_dir)
    return time_index.live_genres_at(spark, path, instants)


def q_live_movies_at_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live movie lists of 20 instants and window lengths, exact, from the time index."""
    path, instants = _indexed(spark, sf_dir)
    return time_index.live_movies_at(spark, path, instants)


def _user_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ckpt = fresh_path(spark, "user-state"), fresh_path(spark, "ckpt-user-state")
    _run(
        user_state.start_user_state(
            _event_stream(spark, sf_dir), out, ckpt, USER_BUCKETS, trigger="availableNow", state_partitions=STATE_PARTITIONS
        )
    )
    return user_state.read_user_state(spark, out)


def q_stream_latest_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last rating per (user, movie) as non-expiring streaming state, upserted by batch."""
    return user_state.latest_ratings(_user_state(spark, sf_dir))


def q_stream_liked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The liked set as non-expiring streaming state, upserted by batch."""
    return user_state.liked_pairs(_user_state(spark, sf_dir))


def q_stream_top_genre_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most active genre of each closed day, by two chained aggregates in append mode."""
    events = _event_stream(spark, sf_dir)
    out, ckpt = fresh_path(spark, "top-genre"), fresh_path(spark, "ckpt-top-genre")
    _run(ranked.start_top_per_window(events, out, ckpt, DAY_WINDOW, STREAM_WATERMARK, trigger="availableNow", state_partitions=STATE_PARTITIONS))
    rows = ranked.top_genre_stream(events, DAY_WINDOW, STREAM_WATERMARK)
    return _ntz(_appended(spark, out, rows), "window_start", "window_end")


def _top_closed(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    events = _event_stream(spark, sf_dir)
    out, ckpt = fresh_path(spark, f"closed-{view}"), fresh_path(spark, f"ckpt-closed-{view}")
    _run(
        ranked.start_top_closed(
            view, events, out, ckpt, TREND_WINDOW, watermark=STREAM_WATERMARK, trigger="availableNow", state_partitions=STATE_PARTITIONS
        )
    )
    return _ntz(read_latest(spark, out), "window_start", "window_end")


def q_stream_top_trending_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 (window, genre) rows of closed windows, k rows merged by batch (bounded state)."""
    return _top_closed(spark, sf_dir, "trending")


def q_stream_top_engagement_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 20 engagement rows of closed windows, k rows merged by batch (bounded state)."""
    return _top_closed(spark, sf_dir, "engagement")


def _fanned_out(spark: SparkSession, sf_dir: str):
    events = _event_stream(spark, sf_dir)
    out, ckpt = fresh_path(spark, "fanout"), fresh_path(spark, "ckpt-fanout")
    _run(fanout.start_fanout(events, out, ckpt, TREND_WINDOW, trigger="availableNow"))
    return out, events.schema


def q_stream_fanout_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement windows summed from the partial rows of one read for three sinks."""
    return _ntz(fanout.read_engagement(spark, *_fanned_out(spark, sf_dir)), "window_start", "window_end")


def q_stream_fanout_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend windows of the same read, after compaction of the partial rows."""
    out, schema = _fanned_out(spark, sf_dir)
    fanout.compact(spark, out, schema, least_parts=2)
    return _ntz(fanout.read_trending(spark, out, schema), "window_start", "window_end")


def q_stream_fanout_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lake of the same read, compacted, rows per day and action."""
    out, schema = _fanned_out(spark, sf_dir)
    fanout.compact(spark, out, schema, least_parts=2)
    return lake.partition_counts(fanout.read_sink(spark, out, fanout.RAW, schema))


def q_stream_catalog_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream, each micro-batch joined with the newest published log."""
    events = _event_stream(spark, sf_dir)
    log, out, ckpt = fresh_path(spark, "catalog-log"), fresh_path(spark, "versioned"), fresh_path(spark, "ckpt-versioned")
    catalog_stream.publish_changes(_changes(spark, sf_dir), log, "load", 0)
    _run(catalog_stream.start_versioned(events, log, out, ckpt, trigger="availableNow"))
    return _ntz(catalog_stream.read_versioned(spark, out, events.schema).select(*_VERSIONED), *catalog_history.RANGE)


def q_stream_state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpointed user state held against a batch run whose ratings of 5 became
    NULL: the audit must name exactly the keys that this touches."""
    out, ckpt = fresh_path(spark, "user-state"), fresh_path(spark, "ckpt-user-state")
    stream = _event_stream(spark, sf_dir)
    _run(user_state.start_user_state(stream, out, ckpt, USER_BUCKETS, trigger="availableNow", state_partitions=STATE_PARTITIONS))
    ev = _events(spark, sf_dir)
    planted = ev.withColumn("rating_value", F.when(F.col("rating_value") != 5, F.col("rating_value")))
    found = audit.audit_user_state(spark, ckpt, planted)
    return found.select(
        *user_state.KEY, "problem", F.col("found.rating_value").alias("found_rating"), F.col("expected.rating_value").alias("expected_rating")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
