"""Queries: scalar functions over the columns of topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.checks import check
from topiclake.checks.scans import MURMUR
from topiclake.checks.topics import EV, log, ntz, table
from topiclake.functions import times
from topiclake.functions.hashing import java_hash, key_slot, murmur3_32
from topiclake.functions.positions import pos_cmp, pos_next, pos_prev
from topiclake.functions.topic_names import partition_topic, topic_parts


def _position(ledger, entry, batch):
    return F.struct(ledger.alias("ledger_id"), entry.alias("entry_id"), batch.cast("int").alias("batch_index"))


@check(
    "position_compare",
    """WITH p AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      l_orderkey // 100 AS al, l_partkey % 3 AS ae, CAST(l_linenumber % 4 - 1 AS INTEGER) AS ab,
      l_orderkey // 100 AS bl, l_suppkey % 3 AS be, CAST(l_linenumber % 3 - 1 AS INTEGER) AS bb FROM lineitem)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      CASE WHEN al <> bl THEN SIGN(al - bl) WHEN ae <> be THEN SIGN(ae - be) WHEN ab < 0 OR bb < 0 THEN 0 ELSE SIGN(ab - bb) END::INTEGER AS cmp FROM p""",
)
def position_compare(spark, folder):
    ledger, line = F.expr("l_orderkey DIV 100"), F.col("l_linenumber")
    a = _position(ledger, F.col("l_partkey") % 3, line % 4 - 1)
    b = _position(ledger, F.col("l_suppkey") % 3, line % 3 - 1)
    rows = table(spark, folder, "lineitem").withColumns({"a": a, "b": b})
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", pos_cmp("a", "b").alias("cmp"))


@check(
    "position_next_prev",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey AS next_ledger, l_partkey + 1 AS next_entry, -1 AS next_batch,
      CASE WHEN l_linenumber % 3 = 0 THEN l_partkey - 1 ELSE l_partkey END AS prev_entry,
      CAST(CASE WHEN l_linenumber % 3 = 0 THEN -1 ELSE l_linenumber % 3 - 2 END AS INTEGER) AS prev_batch FROM lineitem""",
)
def position_next_prev(spark, folder):
    pos = _position(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber") % 3 - 1)
    rows = table(spark, folder, "lineitem").withColumn("p", pos).withColumns({"n": pos_next("p"), "v": pos_prev("p")})
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("n.ledger_id").alias("next_ledger"), F.col("n.entry_id").alias("next_entry"),
        F.col("n.batch_index").alias("next_batch"), F.col("v.entry_id").alias("prev_entry"), F.col("v.batch_index").alias("prev_batch"),
    )


@check(
    "topic_name_parts",
    """WITH t AS (SELECT page_id, 'persistent://tenant' || (page_id % 3) || '/ns' || (page_id % 5) || '/page-' || page_id
      || CASE page_id % 4 WHEN 0 THEN '-partition-' || (page_id % 12) WHEN 1 THEN '-partition-0' || (page_id % 12) ELSE '' END AS topic FROM pages)
    SELECT page_id, 'persistent' AS scheme, 'tenant' || (page_id % 3) AS tenant, 'ns' || (page_id % 5) AS namespace,
      CASE WHEN page_id % 4 = 1 THEN 'page-' || page_id || '-partition-0' || (page_id % 12) ELSE 'page-' || page_id END AS local_name,
      CAST(CASE WHEN page_id % 4 = 0 THEN page_id % 12 ELSE -1 END AS INTEGER) AS partition_index, topic AS full_topic FROM t""",
)
def topic_name_parts(spark, folder):
    page = F.col("page_id")
    suffix = (
        F.when(page % 4 == 0, F.concat(F.lit("-partition-"), page % 12))
        .when(page % 4 == 1, F.concat(F.lit("-partition-0"), page % 12))
        .otherwise(F.lit(""))
    )
    topic = F.concat(F.lit("persistent://tenant"), page % 3, F.lit("/ns"), page % 5, F.lit("/page-"), page, suffix)
    rows = table(spark, folder, "pages").select("page_id", topic.alias("topic"))
    parts = rows.select("page_id", topic_parts(F.col("topic")).alias("p")).select("page_id", "p.*")
    plain = F.concat(
        F.col("scheme"), F.lit("://"), F.col("tenant"), F.lit("/"), F.col("namespace"), F.lit("/"), F.col("local_name")
    )
    return parts.withColumn("full_topic", partition_topic(plain, F.col("partition_index")))


@check(
    "string_to_time",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('day', ts) ELSE ts END AS parsed FROM events""",
)
def string_to_time(spark, folder):
    """A date, a timestamp, ISO text with an offset and ISO text with a GMT marker."""
    text = (
        F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(F.col("event_id") % 4 == 2, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00")))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("GMT+01:00")))
    )
    rows = table(spark, folder, "events").select("event_id", text.alias("text"))
    return rows.select("event_id", ntz(times.string_to_time(F.col("text"))).alias("parsed"))


@check(
    "epoch_conversions",
    """SELECT event_id, epoch_us(ts) - 1710000000000000 AS micros, make_timestamp(epoch_us(ts) - 1710000000000000) AS moment,
      CAST(FLOOR((epoch_ms(ts) - 1710000000000) / 86400000.0) AS INTEGER) AS day,
      CAST(FLOOR((epoch_ms(ts) - 1710000000000 + 28800000) / 86400000.0) AS INTEGER) AS day_east,
      CAST(FLOOR(epoch_ms(ts) / 86400000.0) AS BIGINT) * 86400000 - 28800000 AS millis_east FROM events""",
)
def epoch_conversions(spark, folder):
    """Micros, millis and days around the epoch, also in a zone eight hours east."""
    ts = F.col("ts").cast("timestamp")
    shift = 1_710_000_000_000
    rows = table(spark, folder, "events").select(
        "event_id", ts.alias("ts"), (F.unix_micros(ts) - shift * 1000).alias("micros"), (F.unix_millis(ts) - shift).alias("millis")
    )
    return rows.select(
        "event_id",
        times.ts_to_micros(times.micros_to_ts(F.col("micros"))).alias("micros"),
        ntz(times.micros_to_ts(F.col("micros"))).alias("moment"),
        times.millis_to_days(F.col("millis")).alias("day"),
        times.millis_to_days(F.col("millis"), "Asia/Shanghai").alias("day_east"),
        times.days_to_millis(F.unix_date(F.to_date("ts")), "Asia/Shanghai").alias("millis_east"),
    )


@check(
    "timestamp_to_string",
    """SELECT event_id, rtrim(rtrim(strftime(date_trunc(CASE WHEN event_id % 2 = 0 THEN 'second' ELSE 'microsecond' END, ts),
      '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') AS text FROM events WHERE event_id % 2 = 1
    UNION ALL SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') FROM events WHERE event_id % 2 = 0""",
)
def timestamp_to_string(spark, folder):
    ts = F.col("ts").cast("timestamp")
    rows = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", ts)).otherwise(ts).alias("ts")
    )
    return rows.select("event_id", times.ts_to_string(F.col("ts")).alias("text"))


@check(
    "year_month_day",
    """SELECT o_orderkey, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 150000 AS INTEGER) AS d FROM orders)""",
)
def year_month_day(spark, folder):
    rows = table(spark, folder, "orders").withColumn(
        "d", F.date_sub(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 150000).cast("int"))
    )
    return rows.select("o_orderkey", F.year("d").alias("year"), F.month("d").alias("month"), F.dayofmonth("d").alias("day"))


@check(
    "java_string_hash",
    """WITH h AS (SELECT p_partkey, list_reduce(list_transform(string_split(p_name, ''), lambda c: CAST(ord(c) AS BIGINT)),
      lambda acc, c: (acc * 31 + c) & 4294967295, CAST(0 AS BIGINT)) AS hash FROM part)
    SELECT p_partkey, CASE WHEN hash > 2147483647 THEN hash - 4294967296 ELSE hash END AS hash FROM h""",
)
def java_string_hash(spark, folder):
    return table(spark, folder, "part").select("p_partkey", java_hash(F.col("p_name")).alias("hash"))


@check(
    "murmur3_32",
    "WITH ev AS (SELECT DISTINCT c_name || CAST(c_custkey AS VARCHAR) AS key FROM customer), "
    + MURMUR.strip()
    + " SELECT key AS name, hash, CAST(hash & 65535 AS INTEGER) AS slot FROM murmur",
)
def murmur3_32_query(spark, folder):
    rows = table(spark, folder, "customer").select(F.concat("c_name", "c_custkey").alias("name")).distinct()
    key = F.col("name").cast("binary")
    return rows.select("name", murmur3_32(key).alias("hash"), key_slot(key).alias("slot"))


@check(
    "properties_map",
    f"""WITH {EV} SELECT sequence_id, 'events' AS source, 'type' AS name, event_type AS content FROM ev
    UNION ALL SELECT o_orderkey, 'orders', 'priority', o_orderpriority FROM orders""",
)
def properties_map(spark, folder):
    """Properties through their entries and back, without the source."""
    props = F.map_from_entries(F.map_entries("properties"))
    rest = F.map_filter(props, lambda name, _: name != "source")
    m = log(spark, folder).select("sequence_id", props["source"].alias("source"), F.explode(rest).alias("name", "content"))
    return m.select("sequence_id", "source", "name", "content")


