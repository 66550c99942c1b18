"""The message envelope: the one schema every operator takes.

A topic is a DataFrame with one row per message.  ``partition`` is -1 for a topic
without partitions, ``value`` is NULL for a tombstone, and the position of a message
inside its partition is the triple (ledger_id, entry_id, batch_index), where a
batch_index of -1 means that the message was not part of a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("ledger_id", T.LongType()),
        T.StructField("entry_id", T.LongType()),
        T.StructField("batch_index", T.IntegerType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("publish_time", T.TimestampType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("deliver_at", T.TimestampType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    ]
)

#: columns that name one ordered log
LOG = ["topic", "partition"]
#: columns that order the messages of one log
POSITION = ["ledger_id", "entry_id", "batch_index"]
#: order of messages of one key; the columns after the position only matter when a
#: key was written to several partitions
KEY_ORDER = [*POSITION, "publish_time", "partition"]


def position() -> Column:
    """The position of a message as one comparable struct."""
    return F.struct(*POSITION)


def as_envelope(df: DataFrame, **columns: Column | str | int | None) -> DataFrame:
    """Build envelopes from any DataFrame.

    Every keyword names an envelope column and gives the expression that fills it.
    ``topic``, ``entry_id`` and ``value`` are needed; the rest has neutral defaults.
    """
    unknown = set(columns) - set(ENVELOPE.names)
    if unknown:
        raise ValueError(f"not envelope columns: {sorted(unknown)}")
    missing = {"topic", "entry_id", "value"} - set(columns)
    if missing:
        raise ValueError(f"envelope columns without an expression: {sorted(missing)}")
    defaults = {"partition": -1, "ledger_id": 0, "batch_index": -1, "sequence_id": columns["entry_id"]}
    out = []
    for field in ENVELOPE.fields:
        expr = columns.get(field.name, defaults.get(field.name))
        expr = expr if isinstance(expr, Column) else F.lit(expr)
        out.append(expr.cast(field.dataType).alias(field.name))
    return df.select(*out)
