"""Broadcast joins behind a count."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SMALL = 100_000  # narrow rows


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """A broadcast hint for a written or checkpointed table of narrow rows once it is counted and has few;
    beyond ``rows`` Spark plans a shuffled join, whose hot keys AQE splits."""
    return F.broadcast(df) if df.count() <= rows else df
