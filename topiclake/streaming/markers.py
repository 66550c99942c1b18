"""A stream that ends, partition by partition, at its end markers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from topiclake.envelope import LOG
from topiclake.plans.bounded import small_side
from topiclake.sources.starts import before_stops, extreme_position
from topiclake.streaming.sinks import start
from topiclake.streaming.state import BatchState


def _stops(path: str) -> BatchState:
    return BatchState(path, lambda rows: rows.groupBy(*LOG).agg(F.min("stop").alias("stop")))


def stopped(spark: SparkSession, state_path: str, batches: int) -> DataFrame | None:
    """The partitions that had met their marker after ``batches`` micro-batches, with its position ``stop``; None before the first."""
    return _stops(state_path).before(spark, batches)


def until_marker_stream(
    messages: DataFrame,
    marker: Column,
    emit: Callable[[DataFrame, int], None],
    state_path: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """``until_marker`` over a stream: a partition's messages before its first end marker, in whichever micro-batch that comes.

    The marks, one row for each partition that has met one, are kept between micro-batches; later messages of such a partition are dropped.
    ``emit(messages, batch_id)`` gets the same again if a micro-batch is repeated.
    """
    stops = _stops(state_path)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        stops.put(extreme_position(batch.where(marker), lowest=True, name="stop"), batch_id)
        emit(before_stops(batch, small_side(stops.before(batch.sparkSession, batch_id + 1))), batch_id)

    return start(messages, each_batch, checkpoint, available_now=available_now, interval=interval)
