"""Windows of a stream under a watermark per topic partition, for any number of partitions.

Each partition has the highest time it has seen; the watermark of the stream is the lowest of
them less a delay, so a partition that lags holds the windows of all.  A partition that has been silent for long can be
left out until it comes back.  A micro-batch keeps its rows, or what it has added up of them, by window, reads only the windows
that it closes, and removes those that the last one has closed.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from topiclake.envelope import LOG
from topiclake.plans.commits import found, recorded, removed
from topiclake.streaming.sinks import start
from topiclake.streaming.state import BatchState

NONE = "none"


class PartitionMarks:
    """The highest time of every topic partition, and when it last had rows, kept between micro-batches.

    With ``idle_after``, in microseconds of processing time, a partition that had no rows for so long does not hold the
    watermark, not even one that was expected and has never had any.  The watermark after each micro-batch is recorded
    when it is first found and never falls, so rows of a partition that comes back may be late.
    """

    def __init__(
        self, path: str, delay: str, expected: DataFrame | None = None, idle_after: int | None = None, clock: Callable[[], int] = lambda: time.time_ns() // 1000
    ) -> None:
        merge = [F.max("seen").alias("seen"), F.max("active").alias("active")]
        self.state = BatchState(f"{path}/rows", lambda rows: rows.groupBy(*LOG).agg(*merge))
        self.path, self.delay, self.expected, self.idle_after, self.clock = path, delay, expected, idle_after, clock

    def now(self, spark: SparkSession, batch_id: int) -> int:
        """The processing time of a micro-batch, the same whenever it runs; it never goes back."""
        place = f"{self.path}/times/{batch_id}"
        known = recorded(spark, place)
        if known is None:
            last = recorded(spark, f"{self.path}/times/{batch_id - 1}") if batch_id else None
            known = recorded(spark, place, str(max(self.clock(), int(last or 0))))
        return int(known)

    def low(self, spark: SparkSession, batch_id: int) -> int | None:
        """The watermark in microseconds that the batches before this one have reached.

        None before the first row, and while a partition that counts has none.  One number
        comes to the driver.
        """
        if not batch_id:
            return None
        place = f"{self.path}/low/{batch_id}"
        known = recorded(spark, place)
        if known is None:
            mark, last = self._found(spark, batch_id), recorded(spark, f"{self.path}/low/{batch_id - 1}")
            if last not in (None, NONE):
                mark = int(last) if mark is None else max(mark, int(last))
            known = recorded(spark, place, NONE if mark is None else str(mark))
        return None if known == NONE else int(known)

    def _found(self, spark: SparkSession, batch_id: int) -> int | None:
        # a partition whose rows have no time counts as one without rows
        seen = self.state.before(spark, batch_id).where("seen IS NOT NULL")
        if self.expected is not None:
            seen = self.expected.select(*LOG).distinct().join(seen, LOG, "left")
        if self.idle_after is not None:
            # what has never been active counts from the first micro-batch on
            since = self.now(spark, batch_id - 1) - self.idle_after
            begun = F.lit(self.now(spark, 0))
            seen = seen.where(F.coalesce("active", begun) >= since)
        late = F.col("seen") - F.expr(f"INTERVAL {self.delay}")
        row = seen.agg(F.min(F.unix_micros(late)).alias("low"), F.count_if(F.col("seen").isNull()).alias("silent")).first()
        return None if row["silent"] else row["low"]

    def put(self, rows: DataFrame, ts: str, batch_id: int) -> None:
        active = F.lit(self.now(rows.sparkSession, batch_id)).alias("active")
        self.state.put(rows.groupBy(*LOG).agg(F.max(ts).alias("seen"), active), batch_id)


def tumble_stream(
    rows: DataFrame,
    ts: str,
    size: str,
    aggs: list[Column],
    emit: Callable[[DataFrame, int], None],
    state_path: str,
    checkpoint: str,
    *,
    by: list[str] | None = None,
    delay: str = "0 seconds",
    expected: DataFrame | None = None,
    merge: list[Column] | None = None,
    idle_after: int | None = None,
    clock: Callable[[], int] = lambda: time.time_ns() // 1000,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """``tumble`` over a stream whose rows carry topic and partition; ``ts`` is a timestamp.

    A window is emitted in the micro-batch in which the watermark reaches its end, and once.  Rows
    of windows that were closed before are late and left out, rows without time belong to
    none.  ``expected`` partitions (topic, partition) hold the watermark before they have rows.  ``idle_after`` and
    ``clock`` are those of ``PartitionMarks``.

    Open windows keep their rows, unless ``merge`` says how aggregates are put together, for instance
    ``F.sum("n").alias("n")`` for ``F.count("*").alias("n")``: then each micro-batch keeps one row for each window and
    group.  Windows that are closed are removed with the next micro-batch.
    """
    by = by or []
    marks = PartitionMarks(f"{state_path}/marks", delay, expected, idle_after, clock)
    window = F.window(ts, size)
    kept = f"{state_path}/windows"

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = marks.low(spark, batch_id)
        timed = batch.where(F.col(ts).isNotNull()).withColumn("_end", F.unix_micros(window["end"]))
        fresh = timed if before is None else timed.where(F.col("_end") > before)
        if merge is not None:
            fresh = fresh.groupBy("_end", *by).agg(F.min(F.window(ts, size)["start"]).alias("_start"), *aggs)
        # a batch that runs again overwrites what it wrote; the directory is the window
        rows_out = fresh.withColumn("_batch", F.lit(batch_id)).hint("rebalance", "_end")
        rows_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_end", "_batch").parquet(kept)
        marks.put(batch, ts, batch_id)
        now = marks.low(spark, batch_id + 1)
        due = [end for end in _ends(spark, kept) if now is not None and end <= now and (before is None or end > before)]
        if due:
            names = [c for c in fresh.columns if c not in ("_end", "_batch")]
            schema = f"{fresh.select(*names).schema.toDDL()}, _end BIGINT, _batch BIGINT"
            closed = spark.read.schema(schema).option("basePath", kept).parquet(*[f"{kept}/_end={end}" for end in due])
            emit(_closed(closed.where(F.col("_batch") <= batch_id), ts, size, aggs, merge, by), batch_id)
        _removed(spark, kept, before)

    return start(rows, each_batch, checkpoint, available_now=available_now, interval=interval)


def _closed(rows: DataFrame, ts: str, size: str, aggs: list[Column], merge: list[Column] | None, by: list[str]) -> DataFrame:
    """Closed windows from their rows, or from what micro-batches have added up."""
    if merge is None:
        out = rows.groupBy(F.window(ts, size).alias("_window"), *by).agg(*aggs)
        ends = [F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")]
    else:
        out = rows.groupBy("_end", "_start", *by).agg(*merge)
        ends = [F.col("_start").alias("window_start"), F.timestamp_micros("_end").alias("window_end")]
    return out.select(*ends, *by, *[c for c in out.columns if c not in ("_window", "_end", "_start", *by)])


def _ends(spark: SparkSession, kept: str) -> list[int]:
    """The ends of the windows that are kept."""
    return sorted(int(p.rpartition("=")[2]) for p in found(spark, f"{kept}/_end=*"))


def _removed(spark: SparkSession, kept: str, before: int | None) -> None:
    """Remove the windows that were closed before this micro-batch: it does not read them, nor does a later one."""
    for end in _ends(spark, kept):
        if before is not None and end <= before:
            removed(spark, f"{kept}/_end={end}")
