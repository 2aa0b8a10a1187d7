"""Shared expressions: durations, half-up rounding, share of max, truthiness."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cinepulse.functions.expressions import interval, round_half_up, share_of_max, to_timedelta, truthy


@pytest.mark.parametrize("text", ["5 minutes", "1 day", "30 seconds", "2 Hours"])
def test_durations(spark, text):
    got = spark.range(1).select((F.lit(dt.datetime(2024, 1, 1)) + interval(text)).alias("t")).first().t
    assert got == dt.datetime(2024, 1, 1) + to_timedelta(text)


@pytest.mark.parametrize("text", ["5", "five minutes", "1 day; DROP TABLE x", "", "1 fortnight"])
def test_duration_rejects_other_text(text):
    with pytest.raises(ValueError):
        interval(text)
    with pytest.raises(ValueError):
        to_timedelta(text)


def test_round_half_up_like_math_round(spark):
    df = spark.createDataFrame([(x,) for x in [2.5, -2.5, 2.4, -2.6, 0.5, 25.0]], "x double")
    got = [r.r for r in df.select(round_half_up("x").alias("r")).collect()]
    assert got == [3, -2, 2, -3, 1, 25]


def test_share_of_max_capped(spark):
    df = spark.createDataFrame([(3, 3), (2, 3), (5, 3)], "s long, m long")
    got = [r.p for r in df.select(share_of_max("s", F.col("m")).alias("p")).collect()]
    assert got[0] == 100.0 and round(got[1], 2) == 66.67 and got[2] == 100.0


def test_truthy(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "g string")
    assert [r.t for r in df.select(truthy("g").alias("t")).collect()] == [True, False, False]
