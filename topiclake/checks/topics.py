"""The given tables as message topics, in Spark and in SQL.

Positions are arithmetic on the ids, so no table is sorted to number its messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topiclake.envelope import as_envelope
from topiclake.functions.topic_names import full_name

EVENTS, ORDERS, LINEITEM = (full_name(n) for n in ("events", "orders", "lineitem"))
EVENT_DDL = "event_id BIGINT, event_type STRING, value DOUBLE, props STRING"
ORDER_DDL = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING"
LINE_DDL = "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_returnflag STRING"

#: SQL: events as messages, with the decoded value next to the envelope
EV = f"""ev AS (
  SELECT '{EVENTS}' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id // 1000 AS ledger_id,
         event_id % 1000 AS entry_id, -1 AS batch_index, event_id AS sequence_id, CAST(user_id AS VARCHAR) AS key,
         event_type = 'error' AS tombstone, ts AS publish_time,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE ts END AS event_time,
         event_id, user_id, event_type, value, props
  FROM events)"""
#: SQL: orders as messages
ORD = f"""ord AS (
  SELECT '{ORDERS}' AS topic, CAST(o_custkey % 4 AS INTEGER) AS partition, o_orderkey // 1000 AS ledger_id,
         o_orderkey % 1000 AS entry_id, -1 AS batch_index, o_orderkey AS sequence_id, CAST(o_custkey AS VARCHAR) AS key,
         o_orderdate AS publish_time, o_orderdate AS event_time, *
  FROM orders)"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ntz(column: Column | str) -> Column:
    """A time without zone, as the tables have it."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def json_bytes(*columns: str) -> Column:
    return F.to_json(F.struct(*columns)).cast("binary")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Topic of events keyed by user; an ``error`` event is a tombstone."""
    ts = F.col("ts").cast("timestamp")
    return as_envelope(
        table(spark, folder, "events"),
        topic=EVENTS,
        partition=F.col("user_id") % 4,
        ledger_id=F.expr("event_id DIV 1000"),
        entry_id=F.col("event_id") % 1000,
        sequence_id=F.col("event_id"),
        key=F.col("user_id").cast("string"),
        value=F.when(F.col("event_type") != "error", json_bytes("event_id", "event_type", "value", "props")),
        publish_time=ts,
        event_time=F.when(F.col("event_id") % 10 != 0, ts),
        properties=F.create_map(F.lit("source"), F.lit("events"), F.lit("type"), F.col("event_type")),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Topic of orders keyed by customer."""
    day = F.col("o_orderdate").cast("timestamp")
    return as_envelope(
        table(spark, folder, "orders"),
        topic=ORDERS,
        partition=F.col("o_custkey") % 4,
        ledger_id=F.expr("o_orderkey DIV 1000"),
        entry_id=F.col("o_orderkey") % 1000,
        sequence_id=F.col("o_orderkey"),
        key=F.col("o_custkey").cast("string"),
        value=json_bytes("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
        publish_time=day,
        event_time=day,
        properties=F.create_map(F.lit("source"), F.lit("orders"), F.lit("priority"), F.col("o_orderpriority")),
    )


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Topic of line items keyed by order."""
    day = F.col("l_shipdate").cast("timestamp")
    return as_envelope(
        table(spark, folder, "lineitem"),
        topic=LINEITEM,
        partition=F.col("l_orderkey") % 8,
        ledger_id=F.col("l_orderkey"),
        entry_id=(F.col("l_partkey") * F.lit(10_000_000) + F.col("l_suppkey")) * 8 + F.col("l_linenumber"),
        sequence_id=F.col("l_orderkey"),
        key=F.col("l_orderkey").cast("string"),
        value=json_bytes("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"),
        publish_time=day,
        event_time=day,
        properties=F.create_map(F.lit("source"), F.lit("lineitem")),
    )


def log(spark: SparkSession, folder: str) -> DataFrame:
    """Events and orders as one log."""
    return events(spark, folder).unionByName(orders(spark, folder))


def event_rows(m: DataFrame) -> DataFrame:
    """Events that are not tombstones, decoded."""
    from topiclake.operators.decode import decode

    return decode(m.where(F.col("value").isNotNull()), EVENT_DDL)


def user_id() -> Column:
    return F.col("key").cast("string").cast("bigint")
