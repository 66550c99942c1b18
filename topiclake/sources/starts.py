"""Start positions: from which message each topic partition is read.

A start table has one row per topic partition: ``topic, partition, start, inclusive``.
``start`` NULL means the earliest message.  Positions are found once, before the read
starts, because "latest" must not move while a stream is restarted.  The tables hold
one row per topic partition and are broadcast behind a check of that.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topiclake.envelope import LOG, position
from topiclake.operators.cursors import CURSORS, commit_cursors, commit_rows, current_cursors, read_cursors
from topiclake.plans import commits
from topiclake.plans.bounded import small_rows, small_side
from topiclake.sources.manifest import log_path, pruned

STARTS_DDL = "topic STRING, partition INT, start STRUCT<ledger_id: BIGINT, entry_id: BIGINT, batch_index: INT>, inclusive BOOLEAN"
MARKS_DDL = "topic STRING, partition INT, last STRUCT<ledger_id: BIGINT, entry_id: BIGINT, batch_index: INT>"
POLICIES = ("fail", "earliest", "last")


def extreme_position(m: DataFrame, *, lowest: bool = False, name: str = "last") -> DataFrame:
    """Highest (or lowest) position per topic partition.

    Entries are first reduced per ledger on plain numbers, which hashes and combines
    before the shuffle; a maximum over a struct would sort the whole log instead.
    """
    pick = F.min if lowest else F.max
    per_ledger = m.groupBy(*LOG, "ledger_id", "batch_index").agg(pick("entry_id").alias("entry_id"))
    return per_ledger.groupBy(*LOG).agg(pick(position()).alias(name))


def high_water(m: DataFrame) -> DataFrame:
    """Last position per topic partition."""
    return extreme_position(m)


def captured_marks(log: DataFrame, path: str, marks: Callable[[], DataFrame] | None = None) -> DataFrame:
    """High-water marks of the first start: written once, read again at every restart.

    A stream that starts at latest must not move its start when it is restarted.  Marks count
    once their commit is finished; what a killed first start has left is not looked at.  ``marks`` gives them
    if they are known without reading the log.
    """
    spark = log.sparkSession
    found = marks or (lambda: high_water(log))
    commits.commit(spark, path, "marks", lambda place: found().write.parquet(place))
    return spark.read.schema(MARKS_DDL).parquet(f"{path.rstrip('/')}/commit=marks")


def earliest_starts(parts: DataFrame) -> DataFrame:
    return parts.select(*LOG, *_start(F.lit(None), inclusive=True))


def latest_starts(marks: DataFrame) -> DataFrame:
    """Only messages after the high-water marks."""
    return marks.select(*LOG, *_start(F.col("last"), inclusive=False))


def _start(position_or_null: Column, *, inclusive: bool) -> list[Column]:
    kind = "struct<ledger_id: bigint, entry_id: bigint, batch_index: int>"
    return [position_or_null.cast(kind).alias("start"), F.lit(inclusive).alias("inclusive")]


def position_rows(spark: SparkSession, positions: Mapping[tuple[str, int], tuple[int, ...]]) -> DataFrame:
    """(topic, partition) -> (ledger, entry[, batch]) as a start table, inclusive."""
    rows = [
        (topic, partition, (pos[0], pos[1], pos[2] if len(pos) > 2 else -1), True)
        for (topic, partition), pos in positions.items()
    ]
    return spark.createDataFrame(rows, STARTS_DDL)


def specific_starts(marks: DataFrame, positions: DataFrame) -> DataFrame:
    """Given positions, inclusive; partitions that are not named start at latest.

    Both inputs hold one row per topic partition.  A position for an unknown
    partition is an error.
    """
    unknown = positions.join(marks, LOG, "left_anti").take(5)
    if unknown:
        names = [f"{r['topic']}-partition-{r['partition']}" for r in unknown]
        raise ValueError(f"positions are given for partitions that do not exist: {names}")
    return positions.select(*LOG, "start", F.lit(True).alias("inclusive")).unionByName(
        latest_starts(marks.join(positions, LOG, "left_anti"))
    )


def subscription_starts(
    marks: DataFrame, cursors: DataFrame, subscription: str, default: str = "latest"
) -> DataFrame:
    """From the saved cursor: the message after the last one read.

    A cursor with a batch index goes on inside its entry, one without after the entry; an
    entry of -1 means that nothing of the ledger was read.  Of a table of commits the newest
    row of a partition counts.  Partitions without a cursor start at ``default``.  A
    cursor that a live consumer holds (a column ``active``) is an error.
    """
    current = cursors.where(F.col("subscription") == subscription)
    if "active" in cursors.columns and current.where("active").take(1):
        raise RuntimeError(
            f"subscription {subscription} is held by another consumer, messages could be read twice"
        )
    if "seq" in cursors.columns:
        current = current_cursors(current)
    inside = F.coalesce(F.col("batch_index"), F.lit(-1)) >= 0
    entry = F.when((F.col("entry_id") == -1) | inside, F.col("entry_id")).otherwise(F.col("entry_id") + 1)
    batch = F.when(inside, F.col("batch_index") + 1).otherwise(F.lit(-1))
    at = F.struct(F.col("ledger_id"), entry.alias("entry_id"), batch.cast("int").alias("batch_index"))
    saved = current.groupBy(*LOG).agg(F.max(at).alias("saved"))
    found = F.col("saved").isNotNull()
    fallback = F.lit(None) if default == "earliest" else F.col("last")
    return marks.join(saved, LOG, "left").select(
        *LOG,
        F.when(found, F.col("saved")).otherwise(fallback).alias("start"),
        F.when(found, F.lit(True)).otherwise(F.lit(default == "earliest")).alias("inclusive"),
    )


def new_cursors(starts: DataFrame, cursors: DataFrame, subscription: str) -> DataFrame:
    """Positions to save for partitions that have no cursor of the subscription yet.

    They stand before the start, so reading on from them begins there; entry -1 means that
    nothing was read.
    """
    mine = cursors.where(F.col("subscription") == subscription)
    entry = F.when(F.col("start").isNull(), F.lit(-1)).when(
        F.col("inclusive"), F.greatest(F.col("start.entry_id") - 1, F.lit(-1))
    )
    return starts.join(mine, LOG, "left_anti").select(
        *LOG,
        F.coalesce("start.ledger_id", F.lit(0)).alias("ledger_id"),
        entry.otherwise(F.col("start.entry_id")).alias("entry_id"),
        F.lit(-1).alias("batch_index"),
    )


def kept_cursors(spark: SparkSession, path: str, marks: DataFrame, subscription: str, default: str = "latest") -> DataFrame:
    """The cursors stored at ``path``; partitions of ``marks`` without one of the subscription get theirs first.

    So a first read fixes where the subscription begins, and what is written before the next one is not missed.
    """
    stored = read_cursors(spark, path) if commits.exists(spark, path) else spark.createDataFrame([], CURSORS)
    current = current_cursors(stored)
    missing = new_cursors(subscription_starts(marks, stored, subscription, default), current, subscription)
    if not missing.isEmpty():
        commit_cursors(commit_rows(missing, subscription, time.time_ns() // 1000), path)
    return read_cursors(spark, path)


def resolve_start(current: DataFrame, saved: DataFrame, mode: DataFrame) -> DataFrame:
    """Starts after a restart.

    ``saved`` positions (topic, partition, start) win and were already read.  Partitions
    without one take their row of ``mode``, the start table of the startup mode, and
    the earliest message if that has none.  Saved partitions that are no longer
    part of ``current`` are dropped.
    """
    known = F.col("saved").isNotNull()
    return (
        current.select(*LOG)
        .join(saved.select(*LOG, F.col("start").alias("saved")), LOG, "left")
        .join(mode.select(*LOG, "start", "inclusive"), LOG, "left")
        .select(
            *LOG,
            F.coalesce("saved", "start").alias("start"),
            F.when(known, F.lit(False)).otherwise(F.coalesce("inclusive", F.lit(True))).alias("inclusive"),
        )
    )


def guard_data_loss(starts: DataFrame, marks: DataFrame, policy: str = "fail") -> DataFrame:
    """Treat starts that lie beyond the last position + 1.

    ``fail`` raises when the table is evaluated, ``earliest`` and ``last`` restart
    there.  Starts at the beginning and at entry -1 are always valid.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy}")
    batched = F.col("start.batch_index") >= 0
    before = F.struct(
        F.col("start.ledger_id"),
        F.when(batched, F.col("start.entry_id")).otherwise(F.col("start.entry_id") - 1).alias("entry_id"),
        F.when(batched, F.col("start.batch_index") - 1).otherwise(F.lit(-1)).alias("batch_index"),
    )
    beyond = F.col("start").isNotNull() & (F.col("start.entry_id") != -1) & (before > F.col("last"))
    joined = starts.join(marks.select(*LOG, "last"), LOG, "left").withColumn("beyond", F.coalesce(beyond, F.lit(False)))
    if policy == "fail":
        start = F.when(
            F.col("beyond"),
            F.raise_error(F.concat(F.lit("the start lies beyond the last message of "), F.col("topic"))),
        ).otherwise(F.col("start"))
        return joined.select(*LOG, start.alias("start"), "inclusive")
    reset = F.lit(None) if policy == "earliest" else F.col("last")
    return joined.select(
        *LOG,
        F.when(F.col("beyond"), reset).otherwise(F.col("start")).alias("start"),
        (F.col("inclusive") | F.col("beyond")).alias("inclusive"),
    )


def from_starts(m: DataFrame, starts: DataFrame) -> DataFrame:
    """Messages at or after the start of their partition.

    Partitions without a row were found later and are read from the earliest message.
    Of a stored log only the files that can hold such messages are read, whatever the number of partitions
    and however far one of them lags.
    """
    starts = _one_each(starts).select(*LOG, "start", "inclusive")
    rows = small_rows(starts)
    if rows is None:
        return _reached(pruned(m, starts), starts)
    side = F.broadcast(m.sparkSession.createDataFrame(rows, STARTS_DDL))
    known = [row for row in rows if row["start"] is not None]
    m = pruned(m, side)
    if m.isStreaming or not known or log_path(m) is None:
        return _reached(m, side)
    by_topic: dict[str, list[int]] = {}
    for row in known:
        by_topic.setdefault(row["topic"], []).append(row["partition"])
    started = reduce(Column.__or__, [(F.col("topic") == t) & F.col("partition").isin(parts) for t, parts in by_topic.items()])
    # of the files that a start cuts, row groups of lower ledgers are skipped; the others are another scan, of other directories
    lowest = min(row["start"]["ledger_id"] for row in known)
    return _reached(m.where(started).where(F.col("ledger_id") >= lowest), side).unionByName(m.where(~started))


def _one_each(starts: DataFrame) -> DataFrame:
    """One start per partition, the earliest given: messages must not come twice."""
    first = F.min(F.struct("start", (~F.col("inclusive")).alias("after")))
    found = starts.groupBy(*LOG).agg(F.max(F.col("start").isNull()).alias("whole"), first.alias("first"))
    return found.select(
        *LOG, F.when(~F.col("whole"), F.col("first.start")).alias("start"), (F.col("whole") | ~F.col("first.after")).alias("inclusive")
    )


def _reached(m: DataFrame, starts: DataFrame) -> DataFrame:
    here = position()
    reached = (
        F.col("start").isNull()
        | (here > F.col("start"))
        | (F.col("inclusive") & (here == F.col("start")))
    )
    return m.join(starts, LOG, "left").where(reached).select(m.columns)


def with_start(
    m: DataFrame,
    mode: str = "latest",
    *,
    marks: DataFrame | None = None,
    positions: DataFrame | Mapping[tuple[str, int], tuple[int, ...]] | None = None,
    cursors: DataFrame | None = None,
    subscription: str | None = None,
    default: str = "latest",
    timestamp_ms: int | None = None,
    data_loss: str | None = None,
) -> DataFrame:
    """Messages of ``m`` from a startup mode on.

    ``data_loss`` is the policy of ``guard_data_loss`` for starts that were given or saved.

    ``marks`` are the high-water marks at first start (``high_water`` of the log then);
    without them the marks of ``m`` itself are taken, which needs a batch DataFrame.
    """
    if mode == "earliest":
        return m
    if mode == "timestamp":
        if timestamp_ms is None or not 0 <= timestamp_ms <= time.time() * 1000:
            raise ValueError(f"the start time {timestamp_ms} is not between 0 and now")
        return m.where(F.col("publish_time") >= F.timestamp_millis(F.lit(timestamp_ms)))
    if mode not in ("latest", "specific-offsets", "external-subscription"):
        raise ValueError(f"unknown startup mode {mode}")
    if marks is None:
        if m.isStreaming:
            raise ValueError(f"a stream that starts at {mode} needs marks, see captured_marks")
        marks = small_side(high_water(m))

    def guarded(starts: DataFrame) -> DataFrame:
        return guard_data_loss(starts, marks, data_loss) if data_loss else starts

    if mode == "latest":
        return from_starts(m, latest_starts(marks))
    if mode == "specific-offsets":
        if positions is None:
            raise ValueError("the mode specific-offsets needs positions")
        if not isinstance(positions, DataFrame):
            positions = position_rows(m.sparkSession, positions)
        return from_starts(m, guarded(specific_starts(marks, positions)))
    if cursors is None or subscription is None:
        raise ValueError("the mode external-subscription needs a subscription and its cursors")
    return from_starts(m, guarded(subscription_starts(marks, cursors, subscription, default)))


def until_marker(m: DataFrame, marker: Column) -> DataFrame:
    """Messages before the first end marker of their partition; the marker is not emitted.

    Of a stream the markers must be kept between micro-batches, see ``until_marker_stream``.
    """
    if m.isStreaming:
        raise ValueError("a stream keeps its end markers between micro-batches: use until_marker_stream")
    return before_stops(m, small_side(extreme_position(m.where(marker), lowest=True, name="stop")))


def before_stops(m: DataFrame, stops: DataFrame) -> DataFrame:
    """Messages before the position ``stop`` of their partition; without one all of them."""
    return m.join(stops, LOG, "left").where(F.col("stop").isNull() | (position() < F.col("stop"))).select(m.columns)


def drop_undecodable(decoded: DataFrame, column: str = "data") -> DataFrame:
    """Leave out messages that decode to NULL.

    Positions are taken from the messages before this step, so a bad message is
    passed and not read again.
    """
    return decoded.where(F.col(column).isNotNull())


