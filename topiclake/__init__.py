"""Analytics over partitioned message logs, on Spark DataFrames.

A topic is a DataFrame of envelopes (``topiclake.envelope``).  The session time zone is
UTC throughout.
"""

from topiclake.catalog.connect import insert_into, read_changelog, read_table
from topiclake.catalog.options import TableOptions
from topiclake.envelope import ENVELOPE, as_envelope
from topiclake.operators.assemble import assemble, extended, metadata, value_only, with_key_prefix
from topiclake.operators.changelog import compact, decode_upsert, encode_upsert, latest, latest_as_of, latest_table, normalize
from topiclake.operators.decode import decode, encode, quarantine
from topiclake.operators.eventtime import (
    audit,
    backlog,
    gap_ranges,
    partition_watermark,
    positions,
    split_late,
    tumble,
    with_event_time,
)
from topiclake.operators.routing import route
from topiclake.operators.sinks import due, to_messages, upsert_messages, write, write_upsert
from topiclake.operators.temporal import as_of_join, intervals
from topiclake.sources.starts import (
    drop_undecodable,
    from_starts,
    guard_data_loss,
    high_water,
    resolve_start,
    until_marker,
    with_start,
)
from topiclake.sources.topics import (
    assign_partitions,
    discover_partitions,
    key_range_scan,
    key_ranges,
    partitions,
    read_log,
    scan,
    stream_log,
    topic_diff,
)
from topiclake.streaming.sinks import write_stream, write_upsert_stream
from topiclake.streaming.temporal import as_of_join_stream
from topiclake.streaming.upsert import normalize_stream

__all__ = [
    "as_envelope", "as_of_join", "as_of_join_stream", "assemble", "assign_partitions", "audit", "backlog", "compact",
    "decode", "decode_upsert", "discover_partitions", "drop_undecodable", "due", "encode", "encode_upsert",
    "ENVELOPE", "extended", "from_starts", "gap_ranges", "guard_data_loss", "high_water", "insert_into", "intervals",
    "key_range_scan", "key_ranges", "latest", "latest_as_of", "latest_table", "metadata", "normalize",
    "normalize_stream", "partition_watermark", "partitions", "positions", "quarantine", "read_changelog", "read_log",
    "read_table", "resolve_start", "route", "scan", "split_late", "stream_log", "TableOptions", "to_messages",
    "topic_diff", "tumble", "until_marker", "upsert_messages", "value_only", "with_event_time", "with_key_prefix",
    "with_start", "write", "write_stream", "write_upsert", "write_upsert_stream",
]
