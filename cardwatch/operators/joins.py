"""Join helper: a broadcast hint only behind a count of the side, made each time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``df`` as it is, for the planner and AQE to broadcast by its size in bytes, unless
    the caller states ``max_rows``: then a hint where a count (partial counts in the tasks,
    one number each) shows no more rows than that. Nothing is remembered between calls, so
    a table that has grown is counted again."""
    if max_rows is None or max_rows <= 0:
        return df
    return F.broadcast(df) if df.count() <= max_rows else df
