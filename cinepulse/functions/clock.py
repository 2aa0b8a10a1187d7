"""Time helpers: the as-of instant and ISO-8601 parsing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: ISO-8601 forms of an instant: date, then optionally a time, then optionally a zone.
ISO_EXTENDED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
ISO_COMPACT = r"^([0-9]{4})([0-9]{2})([0-9]{2})T([0-9]{2})([0-9]{2})([0-9]{2})"


def as_of_column(events: DataFrame | None, as_of=None, time_col: str = "event_time") -> Column:
    """The instant a live snapshot is taken at.

    * a ``datetime``/``str`` -> literal (lets Parquet and ``dt`` pruning use it);
    * a Column -> used as is (e.g. ``current_timestamp()`` for a live job);
    * None -> ``max(time_col)`` of ``events`` as a scalar subquery: evaluated
      once, by a partial/final aggregate, never collected by our code.
    """
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        # A TIMESTAMP_NTZ literal from text: independent of the Python process's
        # time zone (a plain ``lit(datetime)`` goes through it). Aware -> UTC first.
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp_ntz")
    if events is None:
        raise ValueError("as_of or events is required")
    return events.select(F.max(time_col)).scalar()


def resolve_as_of(events: DataFrame, time_col: str = "event_time"):
    """``max(time_col)`` as a Python value: one aggregate job, one scalar to the driver.

    Passing the result as ``as_of`` turns the trailing predicate into a literal, which
    reaches the Parquet reader (``PushedFilters: GreaterThan(ts, ...)``) and skips row
    groups and ``dt`` partitions outside the window; a subquery value cannot.
    """
    return events.agg(F.max(time_col).alias("t")).first()["t"]


def parse_iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text, extended or compact, with a zone offset, ``Z`` or no zone ->
    TIMESTAMP_NTZ in UTC.

    The text is held against the ISO form before it is parsed: a time without a date,
    a lone year or month, blanks around, one-digit parts and zone names give NULL, as
    does text that names no real instant (``try_`` semantics, ANSI safe). Requires a
    UTC session, in which zone-less text is read as UTC.
    """
    c = F.col(c) if isinstance(c, str) else c
    extended = F.regexp_replace(c, ISO_COMPACT, "$1-$2-$3T$4:$5:$6")
    # Spark needs minutes behind an hour.
    extended = F.regexp_replace(extended, r"^(.{10}[T ][0-9]{2})(Z|[+-].*)?$", "$1:00$2")
    return F.when(extended.rlike(ISO_EXTENDED), F.try_to_timestamp(extended)).cast("timestamp_ntz")


def iso_utc_text(c: Column | str, micros: bool = False) -> Column:
    """TIMESTAMP -> ``yyyy-MM-ddTHH:mm:ss[.SSSSSS]Z`` text."""
    c = F.col(c) if isinstance(c, str) else c
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'" if micros else "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return F.date_format(c, pattern)


def iso_naive_text(c: Column | str) -> Column:
    """TIMESTAMP -> zone-less ``yyyy-MM-ddTHH:mm:ss.SSSSSS`` text (Python isoformat)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
