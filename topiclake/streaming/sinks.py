"""Streaming writes with a chosen delivery guarantee.

Every micro-batch is one commit of the log, visible whole or not at all.  ``exactly-once`` names it by
the query and the micro-batch, so a batch that is run again after a failure finds its
commit and writes nothing; the names of two queries, or of a query with a new
checkpoint, differ.  ``at-least-once`` gives every attempt a name of its own.  Cursors are
committed after the write.

Messages that cannot be written can be set aside.  They are part of the same commit, in a hidden folder, whatever it took
to find them, so good and bad ones become visible together and an attempt that is repeated starts anew.
A ``source`` that marks them in the column ``ERROR`` costs no second pass.  If it raises instead, the batch
is cut in quarters until the messages that raise stand alone.  Only errors of a row are treated so: a full disk, a lost
executor or a missing file fail the batch, which then runs again.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from topiclake.envelope import ENVELOPE, LOG, POSITION
from topiclake.operators.cursors import commit_cursors, commit_rows
from topiclake.operators.eventtime import positions
from topiclake.operators.sinks import SEMANTICS, arranged, highest_ledger, upsert_messages, write
from topiclake.plans.commits import commit, commit_once, exists, removed
from topiclake.plans.workspace import new_dir
from topiclake.sources import manifest

log = logging.getLogger("topiclake")
BatchWriter = Callable[[DataFrame, int], None]
#: a ``source`` may give this column: why a message cannot be written, NULL if it can
ERROR = "_error"
#: hidden folder of a commit with the messages that were set aside: as they were read, or as ``source`` marked them
SET_ASIDE = "_set_aside"
#: messages that one task writes
FEW = 100_000


def start(
    stream: DataFrame,
    each_batch: BatchWriter,
    checkpoint: str,
    *,
    available_now: bool = True,
    interval: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Run ``each_batch`` over the stream; the checkpoint makes it go on where it stopped."""
    writer: DataStreamWriter = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.outputMode(output_mode)
    if interval is not None:
        writer = writer.trigger(processingTime=interval)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a query once and keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def row_error(error: BaseException) -> bool:
    """Whether a job failed because of a row: a data exception, an error that an expression raised, or one of a Python function.

    Spark tells by the SQL state: class 22 are data exceptions, P0001 is what a user raised.
    """
    cause = error.java_exception if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
    while cause is not None:
        if cause.getClass().getName().endswith(".PythonException"):
            return True
        try:
            state = cause.getSqlState() or ""
        except (Py4JError, TypeError):  # no error of Spark's own
            state = ""
        if state.startswith("22") or state == "P0001":
            return True
        cause = cause.getCause()
    return isinstance(error, PythonException)


def batch_writer(
    path: str,
    semantic: str = "at-least-once",
    *,
    writer: str | None = None,
    checkpoint: str | None = None,
    fail_on_write: bool = True,
    subscription: str | None = None,
    cursor_path: str | None = None,
    source: Callable[[DataFrame], DataFrame] | None = None,
    quarantine_path: str | None = None,
    new_ledger: bool = False,
) -> BatchWriter:
    """A function that writes one micro-batch of envelopes to the log at ``path``.

    ``exactly-once`` needs a name for the query in its commits: ``writer``, or else the id in
    the ``checkpoint``.
    ``source`` turns messages that were read into messages to write, message by message; cursors of
    ``subscription`` are those of the messages that were read.  With ``fail_on_write``
    off, a message that cannot be written is logged and left out, and kept as it was read, or with its mark,
    below ``quarantine_path``; the others of its batch are written.  With ``new_ledger`` every micro-batch is the next ledger
    of the log, see ``write``.
    """
    if semantic not in SEMANTICS:
        raise ValueError(f"semantic must be one of {SEMANTICS}, not {semantic!r}")
    if semantic == "exactly-once" and not (writer or checkpoint):
        raise ValueError("exactly-once needs the name of the writer or its checkpoint")

    def aside(part: DataFrame, name: str, place: str) -> None:
        log.error("messages of commit %s were not written", name)
        part.write.mode("append").parquet(f"{place}/{SET_ASIDE}")

    def split(part: DataFrame, name: str, place: str, depth: int, few: bool) -> None:
        # quartered until the messages that fail stand alone, the others are written; quarters are stored, so that
        # each one costs its own messages and not those of the whole batch
        spark, stored, seen = part.sparkSession, new_dir(part.sparkSession, "quarters"), Observation()
        quarter = F.shiftright(F.xxhash64(*LOG, *POSITION), 2 * depth).bitwiseAND(3)
        counts = [F.count_if(F.col("_quarter") == number).alias(f"{number}") for number in range(4)]
        cut = part.withColumn("_quarter", quarter).observe(seen, *counts)
        try:
            (cut.coalesce(1) if few else cut.hint("rebalance", "_quarter")).write.partitionBy("_quarter").parquet(stored)
            for number, held in sorted(seen.get.items()):
                if held:
                    write_part(spark.read.schema(part.schema).parquet(f"{stored}/_quarter={number}"), name, place, depth + 1, held)
        finally:
            removed(spark, stored)

    def write_part(part: DataFrame, name: str, place: str, depth: int, held: int = FEW + 1) -> None:
        seen, few = Observation(), held <= FEW
        out = source(part) if source else part
        marked = ERROR in out.columns
        if marked:
            out = out.observe(seen, F.count_if(F.col(ERROR).isNotNull()).alias("bad"))
        if new_ledger:
            out = out.withColumn("ledger_id", F.lit(None).cast("bigint"))
        good = out.where(F.col(ERROR).isNull()) if marked else out
        try:
            envelopes = good.select(*ENVELOPE.names)
            laid = envelopes.coalesce(1).sortWithinPartitions(*LOG, *POSITION) if few else arranged(envelopes)
            laid.write.mode("append").partitionBy(*LOG).parquet(place)
        except Exception as error:
            if fail_on_write or not row_error(error):
                raise
            if held > 1 and depth < 32 and len(part.take(2)) > 1:
                split(part, name, place, depth, few)
                return
            log.exception("a message of commit %s was not written", name)
            aside(part, name, place)
            return
        if marked and seen.get["bad"]:
            if fail_on_write:
                reason = out.where(F.col(ERROR).isNotNull()).first()[ERROR]
                raise ValueError(f"a message cannot be written: {reason}")
            bad = out.where(F.col(ERROR).isNotNull()).select(*ENVELOPE.names, ERROR)
            log.error("%s messages of commit %s were not written", seen.get["bad"], name)
            aside(bad, name, place)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = (writer or query_id(spark, checkpoint)) if semantic == "exactly-once" else uuid.uuid4().hex
        name = f"{own}-{batch_id}"

        def put(place: str) -> None:
            write_part(batch, name, place, 0)
            manifest.keep(spark, place)

        def set_aside(place: str) -> None:
            bad = f"{place}/{SET_ASIDE}"
            if quarantine_path and exists(spark, bad):
                commit(spark, quarantine_path, name, lambda to: spark.read.parquet(bad).write.parquet(to))

        commit_once(spark, path, name, put, floor=(lambda: highest_ledger(spark, path)) if new_ledger else None, before=set_aside)
        if subscription and cursor_path:
            commit_cursors(commit_rows(positions(batch), subscription, time.time_ns() // 1000), cursor_path)

    return write_batch


def write_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str | None = None,
    semantic: str = "at-least-once",
    *,
    fail_on_write: bool = True,
    subscription: str | None = None,
    cursor_path: str | None = None,
    source: Callable[[DataFrame], DataFrame] | None = None,
    quarantine_path: str | None = None,
    new_ledger: bool = False,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Write a stream of envelopes to a log; the other arguments are those of ``batch_writer``."""
    if checkpoint is None:
        if semantic != "none":
            log.warning("no checkpoint given: semantic %s becomes none", semantic)
        semantic, checkpoint = "none", new_dir(messages.sparkSession, "checkpoint")
    writer = batch_writer(
        path, semantic, checkpoint=checkpoint, fail_on_write=fail_on_write, subscription=subscription, cursor_path=cursor_path, source=source,
        quarantine_path=quarantine_path, new_ledger=new_ledger,
    )
    return start(messages, writer, checkpoint, available_now=available_now, interval=interval)


def write_upsert_stream(
    changes: DataFrame, path: str, checkpoint: str, *, output_mode: str = "update", available_now: bool = True, **columns
) -> StreamingQuery:
    """Write a stream of changed rows to a keyed topic, each micro-batch once.

    Every commit is a ledger of its own, so a later row of a key comes after an earlier one.
    The arguments are those of ``upsert_messages``.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own = query_id(batch.sparkSession, checkpoint)
        write(upsert_messages(batch, **columns), path, commit=f"{own}-{batch_id}", new_ledger=True)

    return start(changes, write_batch, checkpoint, available_now=available_now, output_mode=output_mode)

