"""Queries: routing, writing and cursors."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from topiclake.catalog.connect import insert_into, insert_stream, read_table
from topiclake.catalog.options import TableOptions
from topiclake.checks import check
from topiclake.checks.changelogs import NORMAL
from topiclake.checks.scans import MURMUR
from topiclake.checks.topics import EV, EVENT_DDL, LINE_DDL, ORD, ORDER_DDL, events, json_bytes, lineitem, ntz, orders, table, user_id
from topiclake.envelope import LOG
from topiclake.operators import cursors as K, eventtime as E
from topiclake.operators.changelog import decode_upsert, latest
from topiclake.operators.decode import decode
from topiclake.operators.routing import route
from topiclake.operators.sinks import due, to_messages, write
from topiclake.plans.workspace import new_dir
from topiclake.sources.starts import drop_undecodable, high_water, with_start
from topiclake.sources.topics import partitions, read_log, scan, stream_log
from topiclake.streaming.delivery import deliver_stream
from topiclake.streaming.markers import until_marker_stream
from topiclake.streaming.sinks import ERROR, batch_writer, start, write_stream
from topiclake.streaming.temporal import as_of_join_stream
from topiclake.streaming.upsert import normalize_stream
from topiclake.streaming.watermarks import tumble_stream

CUT = "TIMESTAMP '2024-01-20 00:00:00'"


def order_messages(spark, folder, **more):
    rows = table(spark, folder, "orders")
    settings = {
        "topic": "orders",
        "key": F.col("o_custkey").cast("string").cast("binary"),
        "value": json_bytes("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
        "sequence": F.col("o_orderkey"),
        "publish_time": F.col("o_orderdate").cast("timestamp"),
        **more,
    }
    return to_messages(rows, **settings)


def order_rows(m):
    return decode(m, ORDER_DDL).select("topic", "partition", "data.*")


@check(
    "sink_topic",
    """SELECT 'persistent://public/default/copy' AS topic, CAST(o_orderkey % 3 AS INTEGER) AS partition, o_orderkey,
      o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
)
def sink_topic(spark, folder):
    path = new_dir(spark, "sink")
    write(order_messages(spark, folder, topic="copy", partitions=3), path)
    return order_rows(scan(read_log(spark, path), topic="copy"))


@check(
    "sink_dynamic_topic",
    """SELECT CASE WHEN o_orderstatus = 'O' THEN 'persistent://public/default/open' ELSE 'persistent://public/default/orders' END AS topic,
      -1 AS partition, o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""",
)
def sink_dynamic_topic(spark, folder):
    path = new_dir(spark, "topics")
    chosen = F.when(F.col("o_orderstatus") == "O", F.lit("persistent://public/default/open"))
    write(order_messages(spark, folder, topic_col=chosen), path)
    return order_rows(read_log(spark, path))


@check("key_extractor", "SELECT o_orderstatus || '-' || o_custkey AS key, o_orderkey FROM orders")
def key_extractor(spark, folder):
    m = order_messages(spark, folder, key=F.concat_ws("-", "o_orderstatus", "o_custkey").cast("binary"))
    return m.select(F.col("key").cast("string").alias("key"), F.col("sequence_id").alias("o_orderkey"))


@check(
    "route_key_hash",
    f"WITH {EV}, {MURMUR} SELECT key, event_id AS sequence_id, CAST(ABS(hash) % 5 AS INTEGER) AS partition FROM ev JOIN murmur USING (key)",
)
def route_key_hash(spark, folder):
    return route(events(spark, folder), 5, "key-hash").select(F.col("key").cast("string").alias("key"), "sequence_id", "partition")


@check("route_round_robin", "SELECT event_id AS sequence_id, CAST(event_id % 5 AS INTEGER) AS partition FROM events")
def route_round_robin(spark, folder):
    return route(events(spark, folder), 5).select("sequence_id", "partition")


@check("route_custom", "SELECT event_id AS sequence_id, CAST(length(CAST(user_id AS VARCHAR)) % 5 AS INTEGER) AS partition FROM events")
def route_custom(spark, folder):
    return route(events(spark, folder), 5, lambda key, n: F.length(key) % n).select("sequence_id", "partition")


@check(
    "write_metadata",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS event_time, o_orderstatus AS status,
      o_orderkey % 2 = 0 AS has_priority FROM orders""",
)
def write_metadata(spark, folder):
    """An event time before the epoch is not set; a property without a value is dropped."""
    day = F.col("o_orderdate").cast("timestamp")
    before = F.timestamp_micros(F.lit(-1))
    m = order_messages(
        spark,
        folder,
        event_time=F.when(F.col("o_orderkey") % 3 == 0, before).otherwise(day),
        properties=F.create_map(
            F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
        ),
    )
    return m.select(
        F.col("sequence_id").alias("o_orderkey"), ntz("event_time").alias("event_time"), F.col("properties")["status"].alias("status"),
        F.array_contains(F.map_keys("properties"), "priority").alias("has_priority"),
    )


@check(
    "delayed_delivery",
    """SELECT o_orderkey, o_orderdate + INTERVAL 2 DAY AS deliver_at FROM orders WHERE o_orderdate + INTERVAL 2 DAY <= TIMESTAMP '1997-01-01'""",
)
def delayed_delivery(spark, folder):
    m = order_messages(spark, folder, delay_ms=2 * 86_400_000)
    now = F.lit("1997-01-01").cast("timestamp")
    return due(m, now).select(F.col("sequence_id").alias("o_orderkey"), ntz("deliver_at").alias("deliver_at"))


#: the times of three micro-batches
DELIVERED = ("1994-01-01", "1996-01-01", "1998-01-01")


@check(
    "stream_delayed_delivery",
    f"""WITH b AS (SELECT MIN(o_orderkey) AS low, (MAX(o_orderkey) - MIN(o_orderkey) + 3) // 3 AS width FROM orders),
    o AS (SELECT o_orderkey, o_orderdate + INTERVAL 2 DAY AS due, (o_orderkey - low) // width AS part FROM orders, b),
    t AS (SELECT UNNEST([0, 1, 2]) AS batch, UNNEST([{", ".join(f"TIMESTAMP '{d}'" for d in DELIVERED)}]) AS now)
    SELECT o_orderkey, MIN(batch) AS batch FROM o JOIN t ON batch >= part AND now >= due GROUP BY 1""",
)
def stream_delayed_delivery(spark, folder):
    """Orders arrive in three micro-batches, years apart, and are held for two days: each is delivered in the first
    micro-batch after that, once; the latest are still held."""
    m = order_messages(spark, folder, delay_ms=2 * 86_400_000, partitions=4)
    source, path, state = stored_in_parts(spark, m, 3, "sequence_id"), new_dir(spark, "delivered"), new_dir(spark, "held")
    times = iter(DELIVERED)
    deliver_stream(
        stream_log(spark, source, files_per_batch=4), lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}"), state,
        new_dir(spark, "checkpoint"), clock=lambda: int(datetime.fromisoformat(f"{next(times)}T00:00:00+00:00").timestamp()) * 1_000_000,
        bucket=120 * 86_400,
    ).awaitTermination()
    return spark.read.parquet(path).select(F.col("sequence_id").alias("o_orderkey"), "batch")


@check(
    "sink_parallelism",
    "SELECT CAST(l_orderkey % 8 AS INTEGER) AS partition, l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def sink_parallelism(spark, folder):
    path = new_dir(spark, "parallel")
    write(lineitem(spark, folder), path, parallelism=4)
    return decode(read_log(spark, path), LINE_DDL).select("partition", "data.*")


@check(
    "commit_cursors",
    f"""WITH {EV}, cur AS (SELECT partition, MAX(event_id) AS last FROM ev WHERE publish_time < {CUT} GROUP BY 1)
    SELECT partition, sequence_id FROM ev LEFT JOIN cur USING (partition) WHERE last IS NULL OR event_id > last""",
)
def commit_cursors(spark, folder):
    """Commit two sets of positions, then read on from the newer one."""
    path = new_dir(spark, "cursors")
    m = events(spark, folder)
    for seq, until in enumerate(("TIMESTAMP '2024-01-10 00:00:00'", CUT)):
        K.commit_cursors(K.commit_rows(E.positions(m.where(f"publish_time < {until}")), "report", seq), path)
    cursors = K.current_cursors(K.read_cursors(spark, path))
    rest = with_start(m, "external-subscription", cursors=cursors, subscription="report", default="earliest")
    return rest.select("partition", "sequence_id")


@check(
    "resume_stored_log",
    f"""WITH {EV}, mark AS (SELECT partition, MAX(event_id) AS last FROM ev WHERE publish_time < {CUT} GROUP BY 1)
    SELECT partition, sequence_id, key FROM ev LEFT JOIN mark USING (partition) WHERE last IS NULL OR event_id > last""",
)
def resume_stored_log(spark, folder):
    """Read on from saved positions of a stored log: directories and ledgers before them are skipped."""
    path = new_dir(spark, "stored")
    m = events(spark, folder)
    write(m, path)
    marks = high_water(m.where(f"publish_time < {CUT}"))
    rest = with_start(scan(read_log(spark, path), topic="events"), "latest", marks=marks)
    return rest.select("partition", "sequence_id", F.col("key").cast("string").alias("key"))


def stored_in_parts(spark, m, parts: int, by: str):
    """Messages as a log of ``parts`` files per partition, cut along ``by`` so that streams read them in order."""
    path = new_dir(spark, "input")
    bounds = m.agg(F.min(by).alias("low"), F.max(by).alias("high")).first()
    width = max(1, -(-(bounds["high"] - bounds["low"] + 1) // parts))
    for i in range(parts):
        low = bounds["low"] + i * width
        write(m.where((F.col(by) >= low) & (F.col(by) < low + width)), path, commit=f"{i}")
    return path


@check(
    "sink_exactly_once",
    f"WITH {EV} SELECT partition, COUNT(*) AS messages, COUNT(DISTINCT event_id) AS distinct_numbers FROM ev GROUP BY 1",
)
def sink_exactly_once(spark, folder):
    """Two streams and a batch write one log, a stream is started again and a micro-batch is run
    again; a stream that follows the log gets every message of the topic once, tombstones too."""
    source = stored_in_parts(spark, events(spark, folder), 3, "sequence_id")
    other = stored_in_parts(spark, orders(spark, folder), 2, "sequence_id")
    path, checkpoint, follows = new_dir(spark, "exactly"), new_dir(spark, "checkpoint"), new_dir(spark, "follows")
    out, out_checkpoint = new_dir(spark, "follower"), new_dir(spark, "checkpoint")

    def follow():
        write_stream(stream_log(spark, path), out, out_checkpoint, "exactly-once").awaitTermination()

    write_stream(stream_log(spark, source, files_per_batch=4), path, checkpoint, "exactly-once").awaitTermination()
    follow()
    write_stream(stream_log(spark, other), path, follows, "exactly-once").awaitTermination()
    write(orders(spark, folder), path)
    again = batch_writer(path, "exactly-once", checkpoint=checkpoint)
    again(read_log(spark, f"{source}/commit=0"), 0)
    write_stream(stream_log(spark, source, files_per_batch=4), path, checkpoint, "exactly-once").awaitTermination()
    follow()
    return E.audit(scan(read_log(spark, out), topic="events")).select("partition", "messages", "distinct_numbers")


@check(
    "stream_tumble_agg",
    f"""WITH {EV}, rows AS (SELECT * FROM ev WHERE NOT tombstone)
    SELECT date_trunc('day', publish_time) AS window_start, COUNT(*) AS events, MAX(value) AS highest FROM rows GROUP BY 1
    HAVING date_trunc('day', publish_time) + INTERVAL 1 DAY <= (SELECT MAX(publish_time) FROM rows)""",
)
def stream_tumble_agg(spark, folder):
    """The daily windows of a stream; the last window is still open and tombstones fall into none."""
    source = stored_in_parts(spark, events(spark, folder), 3, "sequence_id")
    path, checkpoint = new_dir(spark, "windows"), new_dir(spark, "checkpoint")
    rows = drop_undecodable(decode(stream_log(spark, source), EVENT_DDL)).select("publish_time", "data.*")
    out = E.tumble(rows, "publish_time", "1 day", [F.count("*").alias("events"), F.max("value").alias("highest")])
    start(out, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/part={n}"), checkpoint).awaitTermination()
    return spark.read.parquet(path).select(ntz("window_start").alias("window_start"), "events", "highest")


@check(
    "stream_partition_watermark",
    f"""WITH {EV}, rows AS (SELECT *, user_id % 64 AS part FROM ev WHERE user_id % 64 <> 5 OR event_id <= (SELECT MAX(event_id) * 3 // 4 FROM ev)),
    low AS (SELECT MIN(seen) AS low FROM (SELECT MAX(publish_time) AS seen FROM rows GROUP BY part))
    SELECT date_trunc('day', publish_time) AS window_start, COUNT(*) AS events, CAST(COUNT(CASE WHEN tombstone THEN 1 END) AS BIGINT) AS tombstones FROM rows
    WHERE date_trunc('day', publish_time) + INTERVAL 1 DAY <= (SELECT low FROM low) GROUP BY 1""",
)
def stream_partition_watermark(spark, folder):
    """Daily windows over 64 partitions, of which one arrives four micro-batches later than the others."""
    m = events(spark, folder).withColumn("partition", (F.col("key").cast("string").cast("bigint") % 64).cast("int"))
    last = m.agg(F.max("sequence_id")).first()[0]
    path = new_dir(spark, "input")
    part = F.floor(F.col("sequence_id") * 8 / (last + 1)) + F.when(F.col("partition") == 5, 4).otherwise(0)
    # the slow partition is three quarters through when the others are done
    slow = (F.col("partition") != 5) | (F.col("sequence_id") <= F.lit(last * 3 // 4))
    for i in range(12):
        write(m.where(slow & (part == i)), path, commit=f"{i:02}")
    out, state, checkpoint = (new_dir(spark, n) for n in ("windows", "state", "checkpoint"))
    stream = stream_log(spark, path, files_per_batch=64).select(*LOG, "publish_time", "value")
    aggs = [F.count("*").alias("events"), F.count_if(F.col("value").isNull()).alias("tombstones")]
    tumble_stream(
        stream, "publish_time", "1 day", aggs, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/part={n}"), state, checkpoint,
        expected=partitions(m),
    ).awaitTermination()
    found = spark.read.schema("window_start TIMESTAMP, window_end TIMESTAMP, events BIGINT, tombstones BIGINT").parquet(out)
    return found.select(ntz("window_start").alias("window_start"), "events", "tombstones")


@check(
    "stream_stop_at_marker",
    f"""WITH {EV}, stop AS (SELECT partition, MIN(event_id) AS stop FROM ev
      WHERE event_type = 'purchase' AND event_id % 100 >= 90 AND event_id * 6 >= (SELECT MAX(event_id) FROM ev) * (partition + 1) GROUP BY 1)
    SELECT partition, sequence_id FROM ev LEFT JOIN stop USING (partition) WHERE stop IS NULL OR event_id < stop""",
)
def stream_stop_at_marker(spark, folder):
    """Four partitions meet their end markers in different micro-batches of six; what comes after is not read."""
    m = events(spark, folder)
    last = m.agg(F.max("sequence_id")).first()[0]
    late = F.col("sequence_id") * 6 >= F.lit(last) * (F.col("partition") + 1)
    marker = (F.col("properties")["type"] == "purchase") & (F.col("sequence_id") % 100 >= 90) & late
    source, path = stored_in_parts(spark, m, 6, "sequence_id"), new_dir(spark, "stopped")
    until_marker_stream(
        stream_log(spark, source, files_per_batch=4), marker, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}"),
        new_dir(spark, "state"), new_dir(spark, "checkpoint"),
    ).awaitTermination()
    return spark.read.parquet(path).select("partition", "sequence_id")


@check(
    "stream_changelog_normalize",
    f"""WITH {EV}, last AS (SELECT user_id, MAX(event_id) AS event_id FROM ev GROUP BY 1)
    SELECT user_id, event_type, value FROM ev JOIN last USING (user_id, event_id) WHERE NOT tombstone""",
)
def stream_changelog_normalize(spark, folder):
    """The changelog of a stream in three micro-batches, read back as the current table."""
    source = stored_in_parts(spark, events(spark, folder), 3, "sequence_id")
    path, state, checkpoint = (new_dir(spark, name) for name in ("changes", "state", "checkpoint"))
    rows = decode_upsert(
        stream_log(spark, source, files_per_batch=4),
        {"user_id": F.col("key").cast("string").cast("bigint")},
        "event_type STRING, value DOUBLE",
    )
    normalize_stream(
        rows, ["user_id"], state, checkpoint, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/part={n}"),
        columns=["event_type", "value"],
    ).awaitTermination()
    order = ["ledger_id", "entry_id", "batch_index", "step"]
    return latest(spark.read.parquet(path), ["user_id"], order).select("user_id", "event_type", "value")




@check(
    "stream_changelog_rows",
    f"WITH {NORMAL} SELECT row_kind, user_id, event_type, value, event_id, step FROM normal",
)
def stream_changelog_rows(spark, folder):
    """Every row of the changelog of a stream in four micro-batches, whose state is in few buckets."""
    source = stored_in_parts(spark, events(spark, folder), 4, "sequence_id")
    path, state, checkpoint = (new_dir(spark, name) for name in ("changes", "state", "checkpoint"))
    rows = decode_upsert(stream_log(spark, source, files_per_batch=4), {"user_id": user_id()}, "event_type STRING, value DOUBLE")
    normalize_stream(
        rows, ["user_id"], state, checkpoint, lambda df, n: df.write.mode("overwrite").parquet(f"{path}/part={n}"),
        columns=["event_type", "value"], buckets=7,
    ).awaitTermination()
    found = spark.read.parquet(path).withColumn("event_id", F.col("ledger_id") * 1000 + F.col("entry_id"))
    return found.select("row_kind", "user_id", "event_type", "value", "event_id", "step")


@check(
    "sink_at_least_once",
    f"WITH {ORD} SELECT partition, sequence_id FROM ord",
)
def sink_at_least_once(spark, folder):
    """Every order arrives at least once; here nothing fails, so exactly once."""
    source = stored_in_parts(spark, orders(spark, folder), 2, "sequence_id")
    path, checkpoint = new_dir(spark, "least"), new_dir(spark, "checkpoint")
    write_stream(stream_log(spark, source, files_per_batch=4), path, checkpoint, "at-least-once").awaitTermination()
    return read_log(spark, path).select("partition", "sequence_id")


@check(
    "stream_temporal_join",
    """WITH views AS (SELECT event_id AS view_id, user_id, ts FROM events WHERE event_type = 'view'),
    versions AS (SELECT user_id, ts AS since, value AS price, event_type = 'error' AS gone FROM events WHERE event_type IN ('purchase', 'error')),
    mark AS (SELECT LEAST((SELECT MAX(ts) FROM views), (SELECT MAX(since) FROM versions)) AS mark)
    SELECT view_id, v.user_id, CASE WHEN NOT gone THEN price END AS price FROM views v CROSS JOIN mark
    ASOF LEFT JOIN versions r ON v.user_id = r.user_id AND v.ts >= r.since WHERE v.ts <= mark""",
)
def stream_temporal_join(spark, folder):
    """Views with the price of the user at their time, in three micro-batches; the last views are not final yet."""
    source = stored_in_parts(spark, events(spark, folder), 3, "sequence_id")
    path, state, checkpoint = (new_dir(spark, name) for name in ("joined", "state", "checkpoint"))
    kind = F.col("properties")["type"]
    value = F.when(kind == "purchase", F.get_json_object(F.col("value").cast("string"), "$.value").cast("double"))
    both = (
        stream_log(spark, source, files_per_batch=4)
        .where(kind.isin("view", "purchase", "error"))
        .select(
            F.when(kind == "view", "left").otherwise("right").alias("side"),
            F.col("key").cast("string").cast("bigint").alias("user_id"),
            "publish_time",
            F.when(kind == "view", F.col("sequence_id")).alias("view_id"),
            value.alias("price"),
            (kind == "error").alias("gone"),
        )
    )
    as_of_join_stream(
        both, ["user_id"], "publish_time", ["view_id"], ["price", "gone"], state, checkpoint,
        lambda df, n: df.write.mode("overwrite").parquet(f"{path}/part={n}"), deleted="gone",
    ).awaitTermination()
    return spark.read.parquet(path).select("view_id", "user_id", "price")


@check(
    "sink_passing_fault",
    f"WITH {ORD} SELECT partition, COUNT(*) AS messages, COUNT(DISTINCT sequence_id) AS distinct_numbers FROM ord GROUP BY 1",
)
def sink_passing_fault(spark, folder):
    """A micro-batch fails once for no lasting reason, is halved, and killed when one half is written; it runs again
    without faults, and a stream started anew finds nothing left to do: every message is there once."""
    source, path, checkpoint = stored_in_parts(spark, orders(spark, folder), 2, "sequence_id"), new_dir(spark, "once"), new_dir(spark, "checkpoint")
    calls = iter(range(1_000))

    def faulty(part):
        turn = next(calls)
        if turn == 2:
            raise OSError("killed")
        return part.withColumn("value", F.raise_error(F.lit("for now")).cast("binary")) if turn == 0 else part

    for _ in range(3):
        query = write_stream(stream_log(spark, source), path, checkpoint, "exactly-once", source=faulty, fail_on_write=False)
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if "killed" not in str(error):
                raise
    return E.audit(read_log(spark, path)).select("partition", "messages", "distinct_numbers")


@check(
    "set_aside_in_one_pass",
    f"WITH {ORD} SELECT partition, sequence_id, CASE WHEN o_orderkey % 7 = 0 THEN 'no price' END AS reason FROM ord",
)
def set_aside_in_one_pass(spark, folder):
    """A source that marks the messages it cannot encode: they are set aside with the reason, in the commit of the others."""
    source, path, bad = stored_in_parts(spark, orders(spark, folder), 2, "sequence_id"), new_dir(spark, "written"), new_dir(spark, "set-aside")
    write_stream(
        stream_log(spark, source), path, new_dir(spark, "checkpoint"), "exactly-once", fail_on_write=False, quarantine_path=bad,
        source=lambda part: part.withColumn(ERROR, F.when(F.col("sequence_id") % 7 == 0, F.lit("no price"))),
    ).awaitTermination()
    good = read_log(spark, path).select("partition", "sequence_id", F.lit(None).cast("string").alias("reason"))
    return good.unionByName(spark.read.parquet(bad).select("partition", "sequence_id", F.col(ERROR).alias("reason")))


@check(
    "insert_batch_and_stream",
    "SELECT user_id, ARG_MAX(event_type, event_id) AS event_type, ARG_MAX(value, event_id) AS value FROM events GROUP BY 1",
)
def insert_batch_and_stream(spark, folder):
    """A table is written by batches and streams in turn, each with lower numbers inside than the one before: what was written
    last is the current row."""
    users = TableOptions(
        StructType.fromDDL("user_id BIGINT, event_type STRING, value DOUBLE"),
        {"topic": "users", "format": "json", "value.fields-include": "EXCEPT_KEY", "scan.startup.mode": "earliest", "sink.semantic": "exactly-once"},
        primary_key=["user_id"], upsert=True,
    )
    rows, path = table(spark, folder, "events"), new_dir(spark, "users")
    last = rows.agg(F.max("event_id")).first()[0]
    order = F.lit(last) - F.col("event_id")
    for i in range(4):
        part = rows.where(F.expr(f"event_id * 4 DIV {last + 1}") == i)
        part = part.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type", "value"), "event_id").alias("r")).select("user_id", "r.*")
        if i % 2 == 0:
            insert_into(part, path, users, order, partitions=4)
        else:
            stored = new_dir(spark, "rows")
            part.write.parquet(stored)
            insert_stream(spark.readStream.schema(part.schema).parquet(stored), path, users, order, new_dir(spark, "checkpoint"), partitions=4).awaitTermination()
    return read_table(read_log(spark, path), users)


@check("sink_none", f"WITH {ORD} SELECT partition, COUNT(*) AS messages FROM ord GROUP BY 1")
def sink_none(spark, folder):
    """A stream without a checkpoint of its own gives no guarantee; here nothing fails."""
    source, path = stored_in_parts(spark, orders(spark, folder), 2, "sequence_id"), new_dir(spark, "none")
    write_stream(stream_log(spark, source), path, semantic="none").awaitTermination()
    return read_log(spark, path).groupBy("partition").agg(F.count("*").alias("messages"))


@check(
    "fail_on_write",
    f"""WITH {ORD} SELECT partition, sequence_id, o_orderkey IN (SELECT MIN(o_orderkey) FROM orders UNION SELECT MAX(o_orderkey) FROM orders) AS quarantined
    FROM ord""",
)
def fail_on_write(spark, folder):
    """Two orders cannot be encoded: they are set aside, all others are written."""
    m = orders(spark, folder)
    ends = m.agg(F.min("sequence_id").alias("low"), F.max("sequence_id").alias("high")).first()
    source, path, bad = stored_in_parts(spark, m, 2, "sequence_id"), new_dir(spark, "written"), new_dir(spark, "set-aside")

    def encode_orders(batch):
        fails = F.raise_error(F.lit("cannot encode this order")).cast("binary")
        return batch.withColumn("value", F.when(F.col("sequence_id").isin(ends["low"], ends["high"]), fails).otherwise(F.col("value")))

    write_stream(
        stream_log(spark, source), path, new_dir(spark, "checkpoint"), source=encode_orders, fail_on_write=False, quarantine_path=bad
    ).awaitTermination()
    good = read_log(spark, path).select("partition", "sequence_id", F.lit(False).alias("quarantined"))
    return good.unionByName(read_log(spark, bad).select("partition", "sequence_id", F.lit(True).alias("quarantined")))


@check(
    "remove_cursor",
    f"""WITH {EV} SELECT 'kept' AS subscription, partition, MAX(event_id) // 1000 AS ledger_id, MAX(event_id) % 1000 AS entry_id FROM ev GROUP BY partition
    UNION ALL SELECT 'outside', partition, MAX(event_id) // 1000, MAX(event_id) % 1000 FROM ev GROUP BY partition""",
)
def remove_cursor(spark, folder):
    """Three subscriptions; one that the read made for itself is removed, one made outside stays."""
    path, last = new_dir(spark, "cursors"), E.positions(events(spark, folder))
    for name, external in (("kept", False), ("gone", False), ("outside", True)):
        K.commit_cursors(K.commit_rows(last, name, 1, external=external), path)
    for name in ("gone", "outside"):
        K.drop_cursor(spark, path, name)
    return K.current_cursors(K.read_cursors(spark, path)).select("subscription", "partition", "ledger_id", "entry_id")


@check("rescale_state", "SELECT CAST(user_id % 8 AS INTEGER) AS partition, COUNT(*) AS messages FROM events GROUP BY 1")
def rescale_state(spark, folder):
    """A stream goes on from its checkpoint with another number of shuffle partitions and new topic partitions."""
    m = events(spark, folder)
    user = F.col("key").cast("string").cast("bigint")
    old, new = m.where(user % 8 < 4), m.where(user % 8 >= 4).withColumn("partition", (user % 8).cast("int"))
    source, path, checkpoint = new_dir(spark, "input"), new_dir(spark, "rescaled"), new_dir(spark, "checkpoint")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for i, (part, tasks) in enumerate(((old, "3"), (new, "5"))):
            write(part, source, commit=f"{i}")
            spark.conf.set("spark.sql.shuffle.partitions", tasks)
            write_stream(stream_log(spark, source), path, checkpoint, "exactly-once").awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return E.audit(read_log(spark, path)).select("partition", "messages")
