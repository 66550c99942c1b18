"""Streaming join of rows with the version that was valid at their time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from topiclake.operators.temporal import as_of_join
from topiclake.plans.commits import recorded
from topiclake.streaming.delivery import BUCKET, HeldBack
from topiclake.streaming.sinks import start
from topiclake.streaming.state import BUCKETS, BatchState, KeyedState

LEFT, RIGHT = "left", "right"
NONE = "none"


def as_of_join_stream(
    both: DataFrame,
    on: list[str],
    ts: str,
    left_columns: list[str],
    right_columns: list[str],
    state_path: str,
    checkpoint: str,
    emit: Callable[[DataFrame, int], None],
    *,
    delay_ms: int = 0,
    how: str = "left",
    right_order: list[str] | None = None,
    deleted: str | None = None,
    buckets: int = BUCKETS,
    bucket_seconds: int = BUCKET,
    available_now: bool = True,
) -> StreamingQuery:
    """``as_of_join`` over one stream of rows and versions.

    ``both`` has a column ``side`` (``left`` or ``right``), the key, the time ``ts`` and the
    columns of either side, NULL on the other.  The watermark is the lower of the highest
    times of both sides minus ``delay_ms``; it never falls.  A left row is final, and emitted once, when
    the watermark has passed it; until then it is kept.  Of the versions below the
    watermark only the newest per key is kept.  Versions that arrive below the
    watermark are late: they do not change rows that were already emitted.

    What the watermark has not passed waits in buckets of ``bucket_seconds``, of which a micro-batch reads those that its watermark passes.
    The newest versions are kept in ``buckets`` by the hash of the key; a micro-batch reads those of its final rows.
    """
    fields = ["side", *on, ts, *left_columns, *right_columns]
    version_fields = [*on, ts, *right_columns]
    waiting = HeldBack(f"{state_path}/waiting", bucket_seconds, ts)
    highs = BatchState(f"{state_path}/marks", lambda rows: rows.groupBy("side").agg(F.max("high").alias("high")))

    def newest(rows: DataFrame) -> DataFrame:
        rest = [c for c in version_fields if c not in on]
        last = F.max_by(F.struct(*rest), F.struct(ts, *(right_order or []))).alias("_newest")
        return rows.groupBy(*on).agg(last).select(*on, "_newest.*").select(*version_fields)

    current = KeyedState(f"{state_path}/versions", on, newest, buckets=buckets)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # read several times below; lost blocks are read from the source again
        fresh = batch.select(*fields).persist()
        try:
            join_batch(fresh, batch_id)
        finally:
            fresh.unpersist()

    def marks(fresh: DataFrame, batch_id: int) -> tuple[int | None, int | None]:
        """The watermark before and after a micro-batch, in microseconds, as first found."""
        spark, place = fresh.sparkSession, f"{state_path}/watermarks"
        before = recorded(spark, f"{place}/{batch_id - 1}") if batch_id else None
        before = None if before in (None, NONE) else int(before)
        highs.put(fresh.groupBy("side").agg(F.max(F.unix_micros(ts)).alias("high")), batch_id)
        known = recorded(spark, f"{place}/{batch_id}")
        if known is None:
            sides = {r["side"]: r["high"] for r in highs.before(spark, batch_id + 1).collect() if r["high"] is not None}
            # without rows of both sides nothing is final yet
            mark = min(sides.values()) - delay_ms * 1000 if len(sides) == 2 else None
            if before is not None:
                mark = before if mark is None else max(mark, before)
            known = recorded(spark, f"{place}/{batch_id}", NONE if mark is None else str(mark))
        return before, None if known == NONE else int(known)

    def join_batch(fresh: DataFrame, batch_id: int) -> None:
        spark = fresh.sparkSession
        before, now = marks(fresh, batch_id)
        passed = F.lit(False) if now is None else F.coalesce(F.unix_micros(ts) <= now, F.lit(False))
        timed = F.col(ts).isNotNull()
        waiting.hold(fresh.where(timed & ~passed), batch_id)
        earlier = waiting.released(fresh, before, now, batch_id)
        # a left row without time matches nothing and waits for nothing
        ready = fresh.where(passed | (~timed & (F.col("side") == LEFT)))
        ready = ready if earlier is None else ready.unionByName(earlier)
        final = ready.where(F.col("side") == LEFT).select(*on, ts, *left_columns)
        arrived = ready.where(F.col("side") == RIGHT).select(*version_fields)
        kept = current.before(spark, arrived.schema, batch_id, current.touched(final))
        versions = arrived if kept is None else arrived.unionByName(kept)
        versions = versions.withColumnRenamed(ts, "version_time")
        order = ["version_time" if c == ts else c for c in right_order or []]
        emit(as_of_join(final, versions, on, ts, "version_time", how, right_order=order, deleted=deleted), batch_id)
        current.put(newest(arrived), batch_id)
        waiting.expire(spark, before)

    return start(both, each_batch, checkpoint, available_now=available_now)
