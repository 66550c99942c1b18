"""Scans: which messages of which topics are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from topiclake.envelope import ENVELOPE, LOG, POSITION
from topiclake.functions.hashing import SLOTS, java_hash, key_slot, let
from topiclake.functions.topic_names import full_name, namespace_of, partition_topic, topic_parts
from topiclake.plans.bounded import small_side
from topiclake.plans.commits import NUMBERED, found
from topiclake.sources.manifest import LOG_PATH, own_ledger

_STORED = T.StructType([*ENVELOPE.fields, T.StructField("commit", T.StringType())])


def _stored(files: DataFrame, path: str, numbered: bool = True) -> DataFrame:
    """Envelopes of stored files; columns that place a message know their log, so that starts can skip files."""
    whole = files.withColumn("ledger_id", own_ledger(F.col("ledger_id"), F.col("commit"))) if numbered else files
    known = {LOG_PATH: path.rstrip("/")}
    return whole.select(*[F.col(c).alias(c, metadata=known if c in (*LOG, *POSITION) else {}) for c in ENVELOPE.names])


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A stored log: parquet directories by commit, topic and partition."""
    files = spark.read.schema(_STORED).parquet(path)
    # where all messages bring their ledger, conditions on it reach the files; asked after the files were listed
    return _stored(files, path, bool(found(spark, f"{path.rstrip('/')}/commit={NUMBERED}*")))


def stream_log(
    spark: SparkSession, path: str, files_per_batch: int | None = None, only: DataFrame | None = None
) -> DataFrame:
    """The same log as a stream; new partition directories are found in each micro-batch.

    ``only`` turns discovery off: the partitions it lists are read and no others.
    """
    reader = spark.readStream.schema(_STORED)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = _stored(reader.parquet(path), path)
    return stream if only is None else stream.join(small_side(only.select(*LOG)), LOG, "left_semi")


def scan(
    log: DataFrame,
    *,
    topic: str | None = None,
    topics: str | list[str] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Messages of one topic, of a list of topics, or of the topics a regex matches in full.

    ``topic`` is a partition directory of a stored log, so the condition prunes files.
    """
    if sum(option is not None for option in (topic, topics, pattern)) != 1:
        raise ValueError("give exactly one of topic, topics and pattern")
    if topic is not None:
        if "," in topic:
            raise ValueError(f"{topic!r} names several topics, give them as topics")
        return log.where(F.col("topic") == full_name(topic))
    if topics is not None:
        names = topics.split(",") if isinstance(topics, str) else topics
        names = [n.strip() for n in names if n.strip()]
        if not names:
            raise ValueError(f"no topic is named in {topics!r}")
        return log.where(F.col("topic").isin([full_name(n) for n in names]))
    return log.where(matches(pattern))


def matches(pattern: str) -> Column:
    """Condition on ``topic``: regex over ``tenant/ns/name``, within the namespace the pattern names."""
    if not pattern.strip():
        raise ValueError("the topic pattern is empty")
    path = full_name(pattern).split("://", 1)[1]
    namespace = "/".join(path.split("/")[:2])
    session = SparkSession.getActiveSession()
    if session is not None:
        # Spark judges its own kind of regex; no data is read
        session.range(1).select(F.lit("").rlike(f"\\A(?:{path})\\z")).collect()
    return (namespace_of(F.col("topic")) == namespace) & F.substring_index("topic", "://", -1).rlike(rf"\A(?:{path})\z")


def with_topic_name(m: DataFrame, column: str = "topic_name") -> DataFrame:
    """The local topic name as a column, to tell the sources of a union apart."""
    return m.withColumn(column, topic_parts(F.col("topic")).getField("local_name"))


def partitions(m: DataFrame) -> DataFrame:
    """The topic partitions that hold messages."""
    return m.select(*LOG).distinct()


def discover_partitions(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Topic partitions that were not seen before; they are read from the earliest message."""
    return current.join(seen, LOG, "left_anti")


def topic_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Topic partitions that were ``added`` or are ``gone`` between two snapshots."""
    old = before.select(*LOG).withColumn("side", F.lit(1))
    new = after.select(*LOG).withColumn("side", F.lit(2))
    sides = old.unionByName(new).groupBy(*LOG).agg(F.min("side").alias("low"), F.max("side").alias("high"))
    return sides.where(F.col("low") == F.col("high")).select(
        *LOG, F.when(F.col("low") == 2, "added").otherwise("gone").alias("change")
    )


def key_ranges(spark: SparkSession, readers: int) -> DataFrame:
    """The key-hash ring cut into ``readers`` contiguous ranges; the first ones get the rest."""
    if readers < 1:
        raise ValueError("at least one reader is needed")
    part, rest = divmod(SLOTS, readers)
    reader = F.col("id")
    start = reader * part + F.least(reader, F.lit(rest))
    size = F.lit(part) + F.when(reader < rest, 1).otherwise(0)
    return spark.range(readers).select(
        reader.cast("int").alias("reader"), start.cast("int").alias("range_start"), (start + size - 1).cast("int").alias("range_end")
    )


def key_range(readers: int, reader: int) -> tuple[int, int]:
    """First and last slot of one reader."""
    if not 0 <= reader < readers:
        raise ValueError(f"reader {reader} of {readers}")
    part, rest = divmod(SLOTS, readers)
    start = reader * part + min(reader, rest)
    return start, start + part + (reader < rest) - 1


def reader_of_slot(slot: Column, readers: int) -> Column:
    """The reader whose range holds a slot."""
    part, rest = divmod(SLOTS, readers)
    large = rest * (part + 1)

    def owner(s: Column) -> Column:
        return F.when(s < large, F.floor(s / (part + 1))).otherwise(rest + F.floor((s - large) / part)).cast("int")

    return let(slot, owner)


def key_range_scan(m: DataFrame, readers: int, reader: int) -> DataFrame:
    """Messages whose key falls in the range of one reader; messages without key count as slot 0 of an empty key."""
    start, end = key_range(readers, reader)
    slot = key_slot(F.coalesce(F.col("key"), F.lit(b"")))
    return m.where(F.exists(F.array(slot), lambda s: s.between(start, end)))  # the hash is computed once


def assign_partitions(parts: DataFrame, readers: int, *, key_ranges: bool = False) -> DataFrame:
    """The reader that owns each topic partition; with key ranges every reader reads all of them."""
    if key_ranges:
        return parts.withColumn("reader", F.explode(F.sequence(F.lit(0), F.lit(readers - 1))))
    # the owner of partition 0 depends on the topic name alone; other partitions follow in turn
    first = F.pmod((java_hash(F.col("topic")) * 31).bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(readers))
    turn = F.greatest(F.col("partition"), F.lit(0))
    return parts.withColumn("reader", F.pmod(first + turn, F.lit(readers)).cast("int"))


def partition_names(parts: DataFrame) -> DataFrame:
    """Topic partitions by the name of the partition topic."""
    return parts.withColumn("partition_topic", partition_topic(F.col("topic"), F.col("partition")))
