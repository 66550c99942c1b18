"""Delayed messages of a stream: held back until they are due, then delivered once.

A micro-batch delivers what is due among its own messages, and of the messages that earlier ones held back those
that have become due since.  Held messages are stored by the hour they are due, so a micro-batch reads the hours
between the last one's time and its own and no others; hours that are past are removed.  The time of a
micro-batch is recorded when it first runs, and never goes back, so one that runs again delivers the same.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from topiclake.plans.commits import exists, found, recorded, removed
from topiclake.streaming.sinks import start

#: seconds of a bucket of held messages
BUCKET = 3600


def ticking(messages: DataFrame, per_second: int = 1) -> DataFrame:
    """The stream with empty messages of a clock, so that held messages are delivered when nothing else arrives.

    ``deliver_stream`` drops them: their topic is NULL.
    """
    clock = messages.sparkSession.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return messages.unionByName(clock.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in messages.schema]))


class HeldBack:
    """Rows that wait for the time in ``column``, in a folder that all executors share, by buckets of so many seconds."""

    def __init__(self, path: str, bucket: int = BUCKET, column: str = "deliver_at") -> None:
        self.path, self.bucket, self.column = path.rstrip("/"), bucket * 1_000_000, column

    def now(self, spark: SparkSession, batch_id: int, clock: Callable[[], int]) -> tuple[int | None, int]:
        """The times of the micro-batch before and of this one, in microseconds."""
        known = recorded(spark, f"{self.path}/times/{batch_id - 1}") if batch_id else None
        before = None if known is None else int(known)
        own = recorded(spark, f"{self.path}/times/{batch_id}") or recorded(
            spark, f"{self.path}/times/{batch_id}", str(clock() if before is None else max(clock(), before))
        )
        return before, int(own)

    def hold(self, rows: DataFrame, batch_id: int) -> None:
        """Keep rows; a micro-batch that runs again replaces its own."""
        at = f"unix_micros(`{self.column}`)"
        due = F.expr(f"({at} - pmod({at}, {self.bucket})) DIV {self.bucket}")
        kept = rows.withColumns({"_due": due, "_batch": F.lit(batch_id)})
        # as many files for a bucket as its rows need
        kept.hint("rebalance", "_due").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_due", "_batch").parquet(
            f"{self.path}/held"
        )

    def released(self, like: DataFrame, before: int | None, now: int | None, batch_id: int) -> DataFrame | None:
        """Rows of earlier micro-batches whose time is after ``before``, if that is known, and until ``now``."""
        if now is None or not exists(like.sparkSession, f"{self.path}/held"):
            return None
        kept = like.sparkSession.read.schema(f"{like.schema.toDDL()}, _due BIGINT, _batch BIGINT").parquet(f"{self.path}/held")
        at, bucket = F.unix_micros(self.column), F.col("_due")
        ready = (F.col("_batch") < batch_id) & (at <= now) & (bucket <= now // self.bucket)
        if before is not None:
            ready = ready & (at > before) & (bucket >= before // self.bucket)
        return kept.where(ready).select(*like.columns)

    def expire(self, spark: SparkSession, before: int | None) -> None:
        """Remove the buckets that were over before the last micro-batch: neither this one nor a later one reads them."""
        if before is None:
            return
        for bucket in found(spark, f"{self.path}/held/_due=*"):
            if int(bucket.rpartition("=")[2]) < before // self.bucket:
                removed(spark, bucket)


def deliver_stream(
    messages: DataFrame,
    emit: Callable[[DataFrame, int], None],
    state_path: str,
    checkpoint: str,
    *,
    clock: Callable[[], int] = lambda: time.time_ns() // 1000,
    bucket: int = BUCKET,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Deliver each message of a stream once, not before its ``deliver_at``; without one at once.

    ``emit(messages, batch_id)`` gets what is due in a micro-batch, and the same again if that is repeated.  ``clock`` gives
    the processing time in microseconds.  Messages wait for a micro-batch: on a stream that may fall silent
    use ``ticking`` and an ``interval``.
    """
    held = HeldBack(state_path, bucket)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, now = held.now(spark, batch_id, clock)
        held.expire(spark, before)
        fresh = batch.where(F.col("topic").isNotNull())
        waits = F.coalesce(F.unix_micros("deliver_at") > now, F.lit(False))
        held.hold(fresh.where(waits), batch_id)
        ready, earlier = fresh.where(~waits), held.released(batch, before, now, batch_id)
        emit(ready if earlier is None else ready.unionByName(earlier), batch_id)

    return start(messages, each_batch, checkpoint, available_now=available_now, interval=interval)
