"""Writing rows as messages of a log."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from topiclake.envelope import ENVELOPE, LOG, POSITION, as_envelope
from topiclake.functions.topic_names import full_name
from topiclake.operators.routing import Router, route
from topiclake.plans import commits
from topiclake.plans.skew import rows_per_task
from topiclake.plans.workspace import new_dir
from topiclake.sources import manifest

SEMANTICS = ("at-least-once", "exactly-once", "none")
#: metadata columns a table may write
WRITABLE = ("eventTime", "properties")


def to_messages(
    df: DataFrame,
    *,
    topic: str,
    value: Column,
    sequence: Column,
    key: Column | None = None,
    topic_col: Column | None = None,
    ledger_id: Column | int = 0,
    publish_time: Column | None = None,
    event_time: Column | None = None,
    properties: Column | None = None,
    delay_ms: int = 0,
    deliver_at: Column | None = None,
    partitions: int = 0,
    router: str | Router = "round-robin",
    mark: str | None = None,
) -> DataFrame:
    """Rows -> envelopes.

    ``topic_col`` picks the topic of a row, NULL means the default ``topic``.
    ``sequence`` orders the messages and becomes their entry, so writing the same rows
    again gives the same messages.  An event time before the epoch is not set, and
    properties without a value are dropped.  A fixed delay counts from the publish time.
    ``mark`` is that of ``route``.
    """
    if "," in topic:
        raise ValueError(f"a sink writes one topic, not {topic!r}")
    target = F.lit(full_name(topic))
    published = F.current_timestamp() if publish_time is None else publish_time
    if deliver_at is None and delay_ms > 0:
        deliver_at = F.timestamp_micros(F.unix_micros(published) + delay_ms * 1000)
    messages = as_envelope(
        df,
        topic=target if topic_col is None else F.coalesce(topic_col, target),
        ledger_id=ledger_id,
        entry_id=sequence,
        sequence_id=sequence,
        key=key,
        value=value,
        publish_time=published,
        event_time=None if event_time is None else F.when(F.unix_micros(event_time) >= 0, event_time),
        deliver_at=deliver_at,
        properties=None if properties is None else F.map_filter(properties, lambda _, v: v.isNotNull()),
    )
    return route(messages, partitions, router, mark=mark) if partitions else messages


def check_writable(columns: list[str]) -> None:
    """Only ``eventTime`` and ``properties`` can be written as metadata."""
    refused = sorted(set(columns) - set(WRITABLE))
    if refused:
        raise ValueError(f"metadata columns {refused} are read-only, writable are {list(WRITABLE)}")


def arranged(messages: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Messages laid out for the writers, in log order inside every file.

    Without ``parallelism`` Spark balances the partitions of the log over tasks, merging
    small and splitting large ones.  With it there are that many writers over ranges of
    the log.  The order of a key is in its positions, so a hot key may span files.
    """
    if parallelism is None:
        spread = messages.hint("rebalance", *LOG)
    else:
        spread = messages.repartitionByRange(parallelism, *LOG, *POSITION)
    return spread.sortWithinPartitions(*LOG, *POSITION)


def write_in_turns(rows: DataFrame, place: str, parallelism: int) -> None:
    """Write messages with ``parallelism`` writers, of which none sorts more rows at once than a task should.

    Ranges of the log that are larger are cut further and stored; the writers take the pieces in log order,
    ``parallelism`` at a time, a file for each piece and partition.
    """
    spark, limit = rows.sparkSession, rows_per_task(rows)
    turns = -(-rows.count() // (limit * parallelism)) if limit else 1
    if turns <= 1:
        arranged(rows, parallelism).write.partitionBy(*LOG).parquet(place)
        return
    stored = new_dir(spark, "ranges")
    try:
        cut = rows.repartitionByRange(parallelism * turns, *LOG, *POSITION).withColumn("_range", F.spark_partition_id())
        cut.write.partitionBy("_range").parquet(stored)
        pieces = sorted((int(p.rpartition("=")[2]), p) for p in commits.found(spark, f"{stored}/_range=*"))
        schema = StructType([*rows.schema.fields, StructField("_range", IntegerType())])
        for first in range(0, len(pieces), parallelism):
            turn = spark.read.schema(schema).option("basePath", stored).parquet(*[p for _, p in pieces[first : first + parallelism]])
            turn = turn.repartitionById(parallelism, F.pmod("_range", F.lit(parallelism))).drop("_range")
            turn.sortWithinPartitions(*LOG, *POSITION).write.mode("append").partitionBy(*LOG).parquet(place)
    finally:
        commits.removed(spark, stored)


def write(
    messages: DataFrame, path: str, *, commit: str | None = None, parallelism: int | None = None, new_ledger: bool = False
) -> bool:
    """Add messages to a log as one commit: a directory per topic and partition.

    ``commit`` names it, a new name unless given; a commit that is there already is left
    as it is, and False comes back.  With ``new_ledger`` the commit is a ledger of its own, the one after
    those before it, as a broker would assign: the number is taken when the commit becomes visible, by batches and
    streams alike.  Otherwise messages bring their ledger.
    """
    spark = messages.sparkSession
    if new_ledger:
        messages = messages.withColumn("ledger_id", F.lit(None).cast("bigint"))
    rows = messages.select(*ENVELOPE.names)

    def put(place: str) -> None:
        if parallelism is None:
            arranged(rows).write.partitionBy(*LOG).parquet(place)
        else:
            write_in_turns(rows, place, parallelism)
        manifest.keep(spark, place)

    name = commit or f"batch-{uuid.uuid4().hex}"
    if new_ledger:
        return commits.commit_once(spark, path, name, put, floor=lambda: highest_ledger(spark, path))
    return commits.commit(spark, path, name, put)


def highest_ledger(spark: SparkSession, path: str) -> int:
    """The highest ledger that messages have brought."""
    return manifest.files(spark, path).agg(F.max("high.ledger_id")).first()[0] or 0


def due(m: DataFrame, now: Column) -> DataFrame:
    """Messages that may be delivered at ``now``."""
    return m.where(F.col("deliver_at").isNull() | (F.col("deliver_at") <= now))


def upsert_messages(
    changes: DataFrame,
    *,
    topic: str,
    pk: list[str],
    columns: list[str],
    sequence: Column,
    partitions: int,
    ledger_id: Column | int = 0,
    publish_time: Column | None = None,
) -> DataFrame:
    """A changelog as messages of a keyed topic: key = primary key, tombstones for ``-D`` and ``-U``."""
    if not pk:
        raise ValueError("an upsert sink needs a primary key")
    dead = F.col("row_kind").isin("-D", "-U")
    return to_messages(
        changes,
        topic=topic,
        key=F.to_json(F.struct(*pk)).cast("binary"),
        value=F.when(~dead, F.to_json(F.struct(*columns)).cast("binary")),
        sequence=sequence,
        ledger_id=ledger_id,
        publish_time=publish_time,
        partitions=partitions,
        router="key-hash",
    )


def write_upsert(changes: DataFrame, path: str, *, parallelism: int | None = None, **columns) -> bool:
    """Write a changelog to a keyed topic; the arguments are those of ``upsert_messages``.

    Without a ``ledger_id`` the commit is a ledger of its own, so its rows come after all before.
    """
    return write(upsert_messages(changes, **columns), path, parallelism=parallelism, new_ledger="ledger_id" not in columns)
