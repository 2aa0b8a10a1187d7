from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]


def t(minute: int, second: int = 0, hour: int = 10) -> dt.datetime:
    return dt.datetime(2024, 1, 15, hour, minute, second)


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
