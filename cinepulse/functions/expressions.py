"""Column expressions shared by the operators (all built-in, JVM side)."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cinepulse import schema as S

_DURATION = re.compile(r"^\s*(\d+)\s+(second|minute|hour|day|week)s?\s*$", re.IGNORECASE)


def interval(duration: str) -> Column:
    """``"5 minutes"`` -> an interval literal column; rejects anything else."""
    m = _DURATION.match(duration)
    if not m:
        raise ValueError(f"not a duration: {duration!r}")
    return F.expr(f"INTERVAL {int(m.group(1))} {m.group(2).upper()}")


def to_timedelta(duration: str) -> dt.timedelta:
    """``"5 minutes"`` -> ``timedelta`` (same grammar as ``interval``)."""
    m = _DURATION.match(duration)
    if not m:
        raise ValueError(f"not a duration: {duration!r}")
    return dt.timedelta(**{f"{m.group(2).lower()}s": int(m.group(1))})


def truthy(c: Column | str) -> Column:
    """Not null and not the empty string (how the live path tests a string)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != F.lit(""))


def is_action(name: str, action_col: str = "action") -> Column:
    return F.col(action_col) == F.lit(name)


def engagement_score(
    views: Column | str = "views",
    likes: Column | str = "likes",
    avg_rating: Column | str = "avg_rating",
    weights: tuple[float, float, float] = (S.VIEW_WEIGHT, S.LIKE_WEIGHT, S.RATING_WEIGHT),
) -> Column:
    """views x 1 + likes x 2 + average rating x 5, as DOUBLE."""
    v, l, r = (F.col(c) if isinstance(c, str) else c for c in (views, likes, avg_rating))
    wv, wl, wr = (float(w) for w in weights)
    return v * F.lit(wv) + l * F.lit(wl) + r * F.lit(wr)


def round_half_up(c: Column | str) -> Column:
    """Rounding with ties toward +infinity (``floor(x + 0.5)``), as BIGINT."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c + F.lit(0.5)).cast("long")


def share_of_max(score: Column | str, max_score: Column) -> Column:
    """``min(score / max * 100, 100)`` as DOUBLE."""
    s = F.col(score) if isinstance(score, str) else score
    return F.least(s.cast("double") / max_score.cast("double") * F.lit(100.0), F.lit(100.0))


def order_key(cols: list[str]) -> Column:
    """A struct used as a total order (first seen / last written)."""
    return F.struct(*[F.col(c) for c in cols])
