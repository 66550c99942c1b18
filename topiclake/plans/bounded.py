"""Broadcast only what is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F

#: rows; with the narrow rows used here (a topic, a partition, a position) about 20 MB
BROADCAST_ROWS = 100_000


def small_rows(df: DataFrame, limit: int = BROADCAST_ROWS) -> list[Row] | None:
    """The rows of ``df`` when there are no more than ``limit``, else None."""
    rows = df.take(limit + 1)
    return rows if len(rows) <= limit else None


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``df``, marked for broadcast when there are no more than ``limit``.

    The rows are fetched once, so the plan that uses them does not compute them again.
    Beyond the limit ``df`` itself comes back without a hint and the join is shuffled.
    """
    rows = small_rows(df, limit)
    return df if rows is None else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
