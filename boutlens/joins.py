"""Broadcasts behind a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A side of at most this many narrow rows is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks ``df`` for broadcast after counting that it has at most ``rows`` rows; else leaves it as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
