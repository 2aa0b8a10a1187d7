"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on the driver's views (``events``, ``part``, ...) and rebuilds the
adapter views ``activity`` and ``catalog`` in a WITH clause.
"""

from __future__ import annotations

_VIEWS = """
activity AS (
  SELECT 'user_' || CAST(e.user_id AS VARCHAR) AS user_id,
         CASE e.event_type WHEN 'view' THEN 'play' WHEN 'click' THEN 'like'
              WHEN 'purchase' THEN 'rate' ELSE e.event_type END AS action,
         CAST(p.p_partkey AS VARCHAR) AS movie_id,
         CASE WHEN e.event_id % 50 = 0 THEN NULL ELSE p.p_type END AS genre,
         e.ts AS event_time,
         CASE WHEN e.event_type = 'purchase' THEN CAST(floor(e.value) AS INTEGER) % 6 END AS rating_value,
         e.event_id
  FROM events e JOIN part p ON p.p_partkey = TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT)
),
catalog AS (
  SELECT p_partkey AS pos, CAST(p_partkey AS VARCHAR) AS movie_id, p_name AS title, p_type AS genre,
         p_size AS duration, p_retailprice AS rating,
         (p_partkey * 37) % 50 AS likes, (p_partkey * 91) % 500 AS views
  FROM part
),
as_of AS (SELECT max(event_time) AS t FROM activity)"""


def _with(*ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {_VIEWS}{extra}\n"


# Engagement metrics over a grouping expression (windowed-family rules).
def _engagement(group_exprs: str, group_names: str) -> str:
    return f"""
SELECT {group_names}, views, likes, avg_rating,
       CAST(views AS DOUBLE) * 1.0 + CAST(likes AS DOUBLE) * 2.0 + avg_rating * 5.0 AS engagement_score
FROM (
  SELECT {group_exprs},
         count(*) FILTER (WHERE action = 'play') AS views,
         count(*) FILTER (WHERE action = 'like') AS likes,
         coalesce(avg(rating_value) FILTER (WHERE action = 'rate'), CAST(0.0 AS DOUBLE)) AS avg_rating
  FROM activity GROUP BY ALL
)"""


_CATALOG_VERSIONS = """changes AS (
  SELECT pos * 3 + v AS change_id, movie_id, v,
         TIMESTAMP '2024-01-01' + to_hours(CAST((v * 10 + pos % 7) * 24 + pos % 24 AS BIGINT)) AS valid_from,
         title || ' v' || CAST(v AS VARCHAR) AS title, genre AS catalog_genre, (v = 2 AND pos % 11 = 0) AS deleted
  FROM catalog, range(3) AS r(v)
),
versions AS (SELECT *, lead(valid_from) OVER (PARTITION BY movie_id ORDER BY valid_from) AS valid_to FROM changes)"""


_TREND_5M = """
SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
       genre, count(*) AS activity_count
FROM activity WHERE genre IS NOT NULL GROUP BY ALL"""

_ENGAGEMENT_5M = _engagement(
    "time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, "
    "time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end, movie_id, genre",
    "window_start, window_end, movie_id, genre",
)

# Live family: trailing day before max(event_time), strict bound.
_RECENT = "recent AS (SELECT * FROM activity WHERE event_time > (SELECT t FROM as_of) - INTERVAL 1 DAY)"
_GENRES = """genres AS (
  SELECT genre, count(*) AS score, min(struct_pack(t := event_time, id := event_id)) AS first_seen
  FROM recent WHERE genre IS NOT NULL AND genre <> '' GROUP BY genre
),
top_genres AS (
  SELECT *, CAST(row_number() OVER (ORDER BY score DESC, first_seen) AS INTEGER) AS position
  FROM (SELECT * FROM genres ORDER BY score DESC, first_seen LIMIT 5)
)"""
_MOVIES = """movie_agg AS (
  SELECT movie_id,
         arg_min_null(genre, struct_pack(t := event_time, id := event_id)) AS genre,
         count(*) FILTER (WHERE action = 'play') AS views,
         count(*) FILTER (WHERE action = 'like') AS likes,
         sum(rating_value) FILTER (WHERE action = 'rate' AND rating_value <> 0) AS total_rating,
         count(*) FILTER (WHERE action = 'rate' AND rating_value <> 0) AS rating_count,
         min(struct_pack(t := event_time, id := event_id)) AS first_seen
  FROM recent WHERE movie_id IS NOT NULL AND movie_id <> '' GROUP BY movie_id
),
movies AS (
  SELECT movie_id, genre, views, likes, first_seen,
         CASE WHEN rating_count > 0 THEN CAST(total_rating AS DOUBLE) / rating_count ELSE CAST(0.0 AS DOUBLE) END AS avg_rating
  FROM movie_agg
),
scored AS (
  SELECT *, CAST(views AS DOUBLE) * 1.0 + CAST(likes AS DOUBLE) * 2.0 + avg_rating * 5.0 AS score FROM movies
),
top_movies AS (
  SELECT *, CAST(row_number() OVER (ORDER BY score DESC, first_seen) AS INTEGER) AS position
  FROM (SELECT * FROM scored ORDER BY score DESC, first_seen LIMIT 10)
)"""

_MESSAGES = """decoded AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE action END AS action,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE movie_id END AS movie_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE genre END AS genre,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') END AS "timestamp",
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE rating_value END AS rating_value,
         event_time,
         event_id % 97 = 0 AS malformed
  FROM activity
)"""

# Messages with odd JSON types: by the remainder of the id, a number as user, an object
# as genre, a rating as text / whole float / true, text behind the object, a rating of 2.5.
_ODD_MESSAGES = """decoded AS (
  SELECT user_id, action, movie_id, genre, strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
         CASE WHEN odd = 5 THEN 1 ELSE rating_value END AS rating_value, event_time, odd, malformed
  FROM (SELECT *, event_id % 31 AS odd, event_id % 97 = 0 OR event_id % 31 = 6 AS malformed FROM activity)
)"""

_REJECT = """CASE WHEN malformed THEN 'malformed'
            WHEN odd = 1 THEN 'invalid_user_id'
            WHEN user_id IS NULL THEN 'missing_user_id'
            WHEN action IS NULL THEN 'missing_action'
            WHEN movie_id IS NULL THEN 'missing_movie_id'
            WHEN odd = 2 THEN 'invalid_genre'
            WHEN genre IS NULL THEN 'missing_genre'
            WHEN odd = 7 THEN 'invalid_rating_value' END"""

# (start, end] one-minute buckets of truthy genres.
_GENRE_BUCKETS = """
SELECT time_bucket(INTERVAL 1 MINUTE, event_time - INTERVAL 1 MICROSECOND) AS bucket_start, genre, count(*) AS score
FROM activity WHERE genre IS NOT NULL AND genre <> '' GROUP BY ALL"""

_RECENT_MINUTE = _RECENT.replace("(SELECT t FROM as_of)", "date_trunc('minute', (SELECT t FROM as_of))")

_SNAPSHOT = """SELECT 'trending_genres' AS section, position, genre AS "key", CAST(score AS DOUBLE) AS score FROM top_genres
UNION ALL
SELECT 'movie_scores' AS section, position, movie_id AS "key", score FROM top_movies"""

_TOP_TRENDING = f"SELECT * FROM ({_TREND_5M}) ORDER BY activity_count DESC, window_start, genre NULLS FIRST LIMIT 10"
_TOP_ENGAGEMENT = (
    f"SELECT * FROM ({_ENGAGEMENT_5M}) ORDER BY engagement_score DESC, window_start, movie_id NULLS FIRST, genre NULLS FIRST LIMIT 20"
)

_LAKE_COUNTS = _with() + """
SELECT CAST(event_time AS DATE) AS dt, action, count(*) AS n FROM activity GROUP BY ALL"""

# 20 instants between bucket edges, each with its own trailing window (registry.INSTANT_STEP, WINDOW_STEP).
_AT_INSTANTS = """instants AS (
  SELECT t - to_microseconds(i * 133867123457) AS as_of,
         t - to_microseconds(i * 133867123457) - INTERVAL 1 DAY - to_microseconds(i * 18180777001) AS low
  FROM as_of, range(20) AS r(i) WHERE t IS NOT NULL
),
recent AS (SELECT i.as_of, a.* FROM activity a JOIN instants i ON a.event_time > i.low AND a.event_time <= i.as_of)"""

# Windows that a watermark of 10 minutes behind the newest event has closed.
_CLOSED = "WHERE window_end <= date_trunc('millisecond', (SELECT t FROM as_of)) - INTERVAL 10 MINUTE"

ORACLE: dict[str, str] = {
    # ingest
    "parse_events": _with(_MESSAGES)
    + """SELECT user_id, action, movie_id, genre, "timestamp", rating_value, event_time FROM decoded""",
    "validate_events": _with(_ODD_MESSAGES)
    + """SELECT user_id, action, movie_id, genre, (SELECT t FROM as_of) AS "timestamp", rating_value, event_time
FROM decoded WHERE """ + _REJECT + " IS NULL",
    "quarantine_counts": _with(_ODD_MESSAGES)
    + "SELECT " + _REJECT + " AS reason, count(*) AS n FROM decoded WHERE " + _REJECT + " IS NOT NULL GROUP BY 1",
    "intake_counts": _with(_ODD_MESSAGES)
    + "SELECT CASE WHEN " + _REJECT + " IS NULL THEN 'accepted' ELSE 'rejected' END AS status, "
    + _REJECT + " AS reason, count(*) AS n FROM decoded GROUP BY ALL",
    "normalize_timestamps": _with(
        """raw AS (
  SELECT event_id,
         CASE event_id % 4 WHEN 0 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ')
                ELSE CASE event_id % 8 WHEN 1 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f')
                           WHEN 2 THEN '' WHEN 3 THEN 'not-a-time' WHEN 5 THEN strftime(event_time, '%H:%M:%S')
                           WHEN 6 THEN strftime(event_time, '%Y') ELSE ' ' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') END
                END AS "timestamp"
  FROM activity
)"""
    )
    + """SELECT event_id, "timestamp", TRY_CAST("timestamp" AS TIMESTAMP) AS event_time
FROM raw WHERE event_id % 4 = 0 OR event_id % 8 = 1""",
    "publish_events": _with()
    + """SELECT user_id, action, movie_id, genre, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", rating_value,
       CAST(len(json_keys(to_json(struct_pack(user_id := user_id, action := action, movie_id := movie_id, genre := genre,
            "timestamp" := strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f'), rating_value := rating_value)))) AS INTEGER) AS n_fields
FROM activity""",
    # windowed
    "trending_windows": _with() + _TREND_5M,
    "trending_top10": _with() + _TOP_TRENDING,
    "stream_top_trending": _with() + _TOP_TRENDING,
    "stream_top_engagement": _with() + _TOP_ENGAGEMENT,
    "top_genre_per_window": _with(
        """daily AS (
  SELECT time_bucket(INTERVAL 1 DAY, event_time) AS window_start,
         time_bucket(INTERVAL 1 DAY, event_time) + INTERVAL 1 DAY AS window_end,
         genre, count(*) AS activity_count
  FROM activity WHERE genre IS NOT NULL GROUP BY ALL
)"""
    )
    + """SELECT window_start, window_end, genre, activity_count FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY activity_count DESC, genre) AS rn FROM daily
) WHERE rn = 1""",
    "engagement_windows": _with() + _ENGAGEMENT_5M,
    "engagement_top20": _with() + _TOP_ENGAGEMENT,
    # live
    "live_trending_genres": _with(_RECENT, _GENRES) + "SELECT genre, score FROM top_genres",
    "live_movie_scores": _with(_RECENT, _MOVIES) + "SELECT movie_id, genre, score, views, likes, avg_rating FROM top_movies",
    "trending_snapshot": _with(_RECENT, _GENRES, _MOVIES) + _SNAPSHOT,
    "health_counts": _with()
    + """SELECT count(*) AS events_processed,
       count(*) FILTER (WHERE event_time > (SELECT t FROM as_of) - INTERVAL 1 DAY) AS events_in_window
FROM activity""",
    "genre_share": _with(_RECENT, _GENRES)
    + """SELECT position AS "rank", genre, score,
       LEAST(CAST(score AS DOUBLE) / CAST(max(score) OVER () AS DOUBLE) * 100.0, 100.0) AS pct_of_max
FROM top_genres WHERE position <= 8""",
    "leaderboard": _with(_RECENT, _MOVIES)
    + """SELECT t.position AS "rank", t.movie_id, c.title, c.genre, CAST(floor(t.score + 0.5) AS BIGINT) AS points, t.views, t.likes
FROM top_movies t JOIN catalog c ON c.movie_id = t.movie_id WHERE t.position <= 5""",
    "headline_movie": _with(_RECENT, _MOVIES)
    + """SELECT movie_id, title, genre, likes, views FROM (
  SELECT 0 AS pref, c.movie_id, c.title, c.genre, c.likes, c.views
  FROM (SELECT movie_id FROM scored ORDER BY score DESC, first_seen LIMIT 1) t JOIN catalog c ON c.movie_id = t.movie_id
  UNION ALL
  SELECT * FROM (SELECT 1 AS pref, movie_id, title, genre, likes, views FROM catalog ORDER BY likes DESC, pos DESC LIMIT 1)
) ORDER BY pref LIMIT 1""",
    "live_genre_buckets": _with() + _GENRE_BUCKETS,
    # raw-event live genres at the max event time floored to the minute
    "live_genres_from_buckets": _with(_RECENT_MINUTE, _GENRES) + "SELECT genre, score FROM top_genres",
    "live_movie_scores_from_buckets": _with(_RECENT_MINUTE, _MOVIES)
    + "SELECT movie_id, genre, score, views, likes, avg_rating FROM top_movies",
    "trending_snapshot_from_buckets": _with(_RECENT_MINUTE, _GENRES, _MOVIES) + _SNAPSHOT,
    # two days after the newest event
    "snapshot_idle": _with(_RECENT.replace("(SELECT t FROM as_of)", "(SELECT t + INTERVAL 2 DAY FROM as_of)"), _GENRES, _MOVIES) + _SNAPSHOT,
    # catalogue
    "catalog_by_genre": _with() + "SELECT * FROM catalog WHERE genre = 'SMALL'",
    "catalog_all": _with() + "SELECT * FROM catalog",
    "catalog_totals": _with() + "SELECT CAST(sum(likes) AS BIGINT) AS total_likes, CAST(sum(views) AS BIGINT) AS total_views FROM catalog",
    "catalog_extremes": _with()
    + """SELECT
  (SELECT movie_id FROM catalog ORDER BY likes DESC, pos DESC LIMIT 1) AS most_liked_id,
  (SELECT title FROM catalog ORDER BY likes DESC, pos DESC LIMIT 1) AS most_liked_title,
  (SELECT movie_id FROM catalog ORDER BY views DESC, pos DESC LIMIT 1) AS most_viewed_id,
  (SELECT title FROM catalog ORDER BY views DESC, pos DESC LIMIT 1) AS most_viewed_title,
  (SELECT movie_id FROM catalog ORDER BY rating DESC, pos DESC LIMIT 1) AS highest_rated_id,
  (SELECT title FROM catalog ORDER BY rating DESC, pos DESC LIMIT 1) AS highest_rated_title""",
    "catalog_counts": _with() + "SELECT count(*) AS movies, count(DISTINCT genre) AS genres FROM catalog",
    # state, reports, lake
    "latest_ratings": _with()
    + """SELECT user_id, movie_id, arg_max(rating_value, struct_pack(t := event_time, id := event_id)) AS rating_value
FROM activity WHERE action = 'rate' AND rating_value IS NOT NULL GROUP BY user_id, movie_id""",
    "liked_pairs": _with() + "SELECT DISTINCT user_id, movie_id FROM activity WHERE action = 'like'",
    "daily_report": _with() + _engagement("CAST(event_time AS DATE) AS day, movie_id, genre", "day, movie_id, genre"),
    "daily_report_from_lake": _with() + _engagement("CAST(event_time AS DATE) AS day, movie_id, genre", "day, movie_id, genre"),
    "monthly_report": _with()
    + _engagement("CAST(date_trunc('month', event_time) AS DATE) AS month, movie_id, genre", "month, movie_id, genre"),
    "lake_write_read": _LAKE_COUNTS,
    "lake_pruned_read": _with()
    + "SELECT movie_id, event_time FROM activity WHERE CAST(event_time AS DATE) = DATE '2024-01-15' AND action = 'play'",
    # streaming
    "stream_trending_genres": _with() + _TREND_5M,
    "stream_engagement_windows": _with()
    + "SELECT * FROM ("
    + _engagement(
        "time_bucket(INTERVAL 1 DAY, event_time) AS window_start, "
        "time_bucket(INTERVAL 1 DAY, event_time) + INTERVAL 1 DAY AS window_end, movie_id, genre",
        "window_start, window_end, movie_id, genre",
    )
    + ") WHERE window_end <= date_trunc('millisecond', (SELECT t FROM as_of)) - INTERVAL 10 MINUTE",
    "stream_live_genres": _with()
    + """SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, genre, count(*) AS score FROM (
  SELECT genre, time_bucket(INTERVAL 15 MINUTE, event_time) - to_minutes(CAST(15 * k AS BIGINT)) AS ws
  FROM activity, range(4) AS r(k) WHERE genre IS NOT NULL AND genre <> ''
) GROUP BY ALL""",
    "stream_raw_lake": _LAKE_COUNTS,
    # closed buckets only: bucket end <= watermark (max event time - 10 minutes)
    "stream_live_buckets": _with()
    + f"SELECT * FROM ({_GENRE_BUCKETS}) "
    + "WHERE bucket_start + INTERVAL 1 MINUTE <= date_trunc('millisecond', (SELECT t FROM as_of)) - INTERVAL 10 MINUTE",
    # the live lists at 20 instants
    "live_genres_at_instants": _with(_AT_INSTANTS)
    + """SELECT as_of, CAST(position AS INTEGER) AS position, genre, score FROM (
  SELECT *, row_number() OVER (PARTITION BY as_of ORDER BY score DESC, first_seen) AS position FROM (
    SELECT as_of, genre, count(*) AS score, min(struct_pack(t := event_time, id := event_id)) AS first_seen
    FROM recent WHERE genre IS NOT NULL AND genre <> '' GROUP BY as_of, genre))
WHERE position <= 5""",
    "live_movies_at_instants": _with(_AT_INSTANTS)
    + """SELECT as_of, CAST(position AS INTEGER) AS position, movie_id, genre, score, views, likes, avg_rating FROM (
  SELECT *, row_number() OVER (PARTITION BY as_of ORDER BY score DESC, first_seen) AS position FROM (
    SELECT *, CAST(views AS DOUBLE) * 1.0 + CAST(likes AS DOUBLE) * 2.0 + avg_rating * 5.0 AS score FROM (
      SELECT as_of, movie_id, arg_min_null(genre, struct_pack(t := event_time, id := event_id)) AS genre,
             count(*) FILTER (WHERE action = 'play') AS views, count(*) FILTER (WHERE action = 'like') AS likes,
             coalesce(avg(rating_value) FILTER (WHERE action = 'rate' AND rating_value <> 0), CAST(0.0 AS DOUBLE)) AS avg_rating,
             min(struct_pack(t := event_time, id := event_id)) AS first_seen
      FROM recent WHERE movie_id IS NOT NULL AND movie_id <> '' GROUP BY as_of, movie_id)))
WHERE position <= 10""",
    # one read for three sinks
    "stream_fanout_trending": _with() + _TREND_5M,
    "stream_fanout_engagement": _with() + _ENGAGEMENT_5M,
    "stream_fanout_lake": _LAKE_COUNTS,
    # ranked views of closed windows
    "stream_top_trending_closed": _with()
    + f"SELECT * FROM ({_TREND_5M}) {_CLOSED} ORDER BY activity_count DESC, window_start, genre LIMIT 10",
    "stream_top_engagement_closed": _with()
    + f"SELECT * FROM ({_ENGAGEMENT_5M}) {_CLOSED} ORDER BY engagement_score DESC, window_start, movie_id NULLS FIRST, genre NULLS FIRST LIMIT 20",
    "stream_top_genre_per_window": _with()
    + """SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, genre, activity_count FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY activity_count DESC, genre) AS place FROM (
    SELECT time_bucket(INTERVAL 1 DAY, event_time) AS window_start, time_bucket(INTERVAL 1 DAY, event_time) + INTERVAL 1 DAY AS window_end,
           genre, count(*) AS activity_count FROM activity WHERE genre IS NOT NULL GROUP BY ALL)
  """ + _CLOSED + """)
WHERE place = 1""",
}
for _name in ("latest_ratings", "liked_pairs"):
    ORACLE[f"stream_{_name}"] = ORACLE[_name]
for _name in ("daily_report", "monthly_report"):
    ORACLE[f"{_name}_incremental"] = ORACLE[_name]
for _name in ("catalog_versions", "stream_catalog_versions"):
    ORACLE[_name] = _with(_CATALOG_VERSIONS) + """SELECT a.event_id, a.movie_id, v.change_id, v.title, v.catalog_genre, v.valid_from, v.valid_to
FROM activity a LEFT JOIN versions v
  ON v.movie_id = a.movie_id AND NOT v.deleted AND a.event_time >= v.valid_from AND (v.valid_to IS NULL OR a.event_time < v.valid_to)"""
# the state holds the true ratings; in the batch run ratings of 5 are NULL
ORACLE["stream_state_audit"] = _with() + """SELECT user_id, movie_id,
       CASE WHEN m = 0 THEN 'unexpected' ELSE 'different' END AS problem, found_rating, expected_rating
FROM (
  SELECT user_id, movie_id,
         arg_max(rating_value, struct_pack(t := event_time, id := event_id)) FILTER (WHERE action = 'rate' AND rating_value IS NOT NULL) AS found_rating,
         arg_max(rating_value, struct_pack(t := event_time, id := event_id)) FILTER (WHERE action = 'rate' AND rating_value <> 5) AS expected_rating,
         count(*) FILTER (WHERE action = 'like' OR (action = 'rate' AND rating_value <> 5)) AS m
  FROM activity WHERE action = 'like' OR (action = 'rate' AND rating_value IS NOT NULL) GROUP BY user_id, movie_id)
WHERE found_rating IS DISTINCT FROM expected_rating OR m = 0"""
