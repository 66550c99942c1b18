"""Queries: scans and start positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.checks import check
from topiclake.checks.topics import EV, EVENTS, ORD, ORDERS, events, lineitem, log, ntz
from topiclake.envelope import LOG
from topiclake.functions.hashing import key_slot
from topiclake.functions.positions import parse_positions
from topiclake.operators.decode import decode
from topiclake.operators.sinks import write
from topiclake.plans.workspace import new_dir
from topiclake.sources import manifest as M, starts as S, topics as T
from topiclake.sources.topics import read_log

CUT = "TIMESTAMP '2024-01-20 00:00:00'"
ROW = "topic, partition, sequence_id"
#: SQL: one row per event with its Murmur3 hash (signed); keys are plain digits
MURMUR = """
murmur AS (
  WITH bytes AS (SELECT DISTINCT key, length(key) AS n, length(key) // 4 AS blocks FROM ev),
  words AS (
    SELECT key, n, blocks,
      list_transform(range(0, blocks), lambda i: CAST(ord(substr(key, i*4+1, 1)) + ord(substr(key, i*4+2, 1)) * 256
        + ord(substr(key, i*4+3, 1)) * 65536 + ord(substr(key, i*4+4, 1)) * 16777216 AS UBIGINT)) AS ks,
      CAST((CASE WHEN n % 4 > 0 THEN ord(substr(key, blocks*4+1, 1)) ELSE 0 END)
        + (CASE WHEN n % 4 > 1 THEN ord(substr(key, blocks*4+2, 1)) * 256 ELSE 0 END)
        + (CASE WHEN n % 4 > 2 THEN ord(substr(key, blocks*4+3, 1)) * 65536 ELSE 0 END) AS UBIGINT) AS t
    FROM bytes),
  mixed AS (
    SELECT key, n,
      list_transform(list_transform(list_transform(ks, lambda k: (k * 3432918353) & 4294967295),
        lambda k: ((k << 15) & 4294967295) | (k >> 17)), lambda k: (k * 461845907) & 4294967295) AS ks,
      (t * 3432918353) & 4294967295 AS t1
    FROM words),
  body AS (
    SELECT key, n, ((((t1 << 15) & 4294967295) | (t1 >> 17)) * 461845907) & 4294967295 AS t2,
      list_reduce(ks, lambda h, k: ((((((xor(h, k)) << 13) & 4294967295) | ((xor(h, k)) >> 19)) * 5) + 3864292196) & 4294967295,
        CAST(0 AS UBIGINT)) AS h
    FROM mixed),
  f0 AS (SELECT key, xor(xor(h, t2), CAST(n AS UBIGINT)) AS h FROM body),
  f1 AS (SELECT key, (xor(h, h >> 16) * 2246822507) & 4294967295 AS h FROM f0),
  f2 AS (SELECT key, (xor(h, h >> 13) * 3266489909) & 4294967295 AS h FROM f1),
  f3 AS (SELECT key, CAST(xor(h, h >> 16) AS BIGINT) AS h FROM f2)
  SELECT key, CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END AS hash FROM f3)"""


def _rows(m):
    return m.select("topic", "partition", "sequence_id")


@check(
    "scan_topic",
    f"WITH {EV} SELECT topic, partition, sequence_id, publish_time FROM ev",
)
def scan_topic(spark, folder):
    m = T.scan(log(spark, folder), topic="events")
    return m.select("topic", "partition", "sequence_id", ntz("publish_time").alias("publish_time"))


@check("scan_topics", f"WITH {EV}, {ORD} SELECT {ROW} FROM ev UNION ALL SELECT {ROW} FROM ord")
def scan_topics(spark, folder):
    return _rows(T.scan(log(spark, folder).unionByName(lineitem(spark, folder)), topics=" events, orders,, "))


@check("scan_topic_pattern", f"WITH {ORD} SELECT {ROW} FROM ord")
def scan_topic_pattern(spark, folder):
    return _rows(T.scan(log(spark, folder), pattern="public/default/o.*s"))


@check(
    "multi_topic_union",
    f"""WITH {EV}, {ORD} SELECT topic_name, COUNT(*) AS messages, MAX(sequence_id) AS last_sequence
    FROM (SELECT 'events' AS topic_name, sequence_id FROM ev UNION ALL SELECT 'orders', sequence_id FROM ord) GROUP BY 1""",
)
def multi_topic_union(spark, folder):
    m = T.with_topic_name(T.scan(log(spark, folder), topics=["events", "orders"]))
    return m.groupBy("topic_name").agg(F.count("*").alias("messages"), F.max("sequence_id").alias("last_sequence"))


@check("start_earliest", f"WITH {EV} SELECT {ROW} FROM ev")
def start_earliest(spark, folder):
    return _rows(S.with_start(events(spark, folder), "earliest"))


@check(
    "start_latest",
    f"""WITH {EV}, mark AS (SELECT partition, MAX(event_id) AS last FROM ev WHERE publish_time < {CUT} GROUP BY 1)
    SELECT {ROW} FROM ev LEFT JOIN mark USING (partition) WHERE last IS NULL OR event_id > last""",
)
def start_latest(spark, folder):
    m = events(spark, folder)
    return _rows(S.with_start(m, "latest", marks=S.high_water(m.where(f"publish_time < {CUT}"))))


@check(
    "start_specific",
    f"""WITH {EV} SELECT {ROW} FROM ev
    WHERE (partition = 0 AND event_id >= 350) OR (partition = 1 AND event_id >= 2500)""",
)
def start_specific(spark, folder):
    positions = {(EVENTS, 0): (0, 350), (EVENTS, 1): (2, 500)}
    return _rows(S.with_start(events(spark, folder), "specific-offsets", positions=positions))


@check(
    "parse_positions",
    f"""WITH {EV} SELECT {ROW}, CASE partition WHEN 2 THEN '0:42:2' ELSE '1:7:3' END AS start_text
    FROM ev WHERE (partition = 2 AND event_id >= 42) OR (partition = 3 AND event_id >= 1007)""",
)
def parse_positions_query(spark, folder):
    from topiclake.functions.positions import position_text

    starts = parse_positions(spark, "0:42:2;1:7:3").select(
        F.lit(EVENTS).alias("topic"),
        "partition",
        F.struct("ledger_id", "entry_id", F.lit(-1).alias("batch_index")).alias("start"),
    )
    m = S.with_start(events(spark, folder), "specific-offsets", positions=starts)
    text = starts.select(*LOG, position_text("start", "partition").alias("start_text"))
    return _rows(m).join(F.broadcast(text), LOG).select("topic", "partition", "sequence_id", "start_text")


@check(
    "start_subscription",
    f"""WITH {EV}, cur AS (SELECT partition, MAX(event_id) AS last FROM ev WHERE publish_time < {CUT} AND partition < 3 GROUP BY 1)
    SELECT {ROW} FROM ev LEFT JOIN cur USING (partition) WHERE last IS NULL OR event_id > last""",
)
def start_subscription(spark, folder):
    m = events(spark, folder)
    read = S.high_water(m.where(f"publish_time < {CUT} AND partition < 3")).select(*LOG, "last.*")
    cursors = read.withColumn("subscription", F.lit("report")).withColumn("active", F.lit(False))
    return _rows(
        S.with_start(m, "external-subscription", cursors=cursors, subscription="report", default="earliest")
    )


@check("start_timestamp", f"WITH {EV} SELECT {ROW} FROM ev WHERE publish_time >= {CUT}")
def start_timestamp(spark, folder):
    return _rows(S.with_start(events(spark, folder), "timestamp", timestamp_ms=1705708800000))


@check(
    "resume_positions",
    f"""WITH {EV}, saved AS (SELECT partition, MAX(event_id) AS last FROM ev WHERE publish_time < {CUT} AND partition < 2 GROUP BY 1)
    SELECT {ROW} FROM ev LEFT JOIN saved USING (partition) WHERE last IS NULL OR event_id > last""",
)
def resume_positions(spark, folder):
    both = log(spark, folder)
    m = T.scan(both, topic="events")
    # the saved state also knows partitions of a topic that is no longer read
    saved = S.high_water(both.where(f"(topic = '{ORDERS}' OR publish_time < {CUT}) AND partition < 2"))
    saved = saved.withColumnRenamed("last", "start")
    parts = T.partitions(m)
    return _rows(S.from_starts(m, S.resolve_start(parts, saved, S.earliest_starts(parts))))


@check(
    "discover_partitions",
    f"""SELECT DISTINCT '{EVENTS}' AS topic, CAST(user_id % 64 AS INTEGER) AS partition FROM events
    WHERE user_id % 64 NOT IN (SELECT user_id % 64 FROM events WHERE ts < TIMESTAMP '2024-01-01 06:00:00')""",
)
def discover_partitions(spark, folder):
    m = events(spark, folder).withColumn("partition", (F.col("key").cast("string").cast("bigint") % 64).cast("int"))
    seen = T.partitions(m.where("publish_time < TIMESTAMP '2024-01-01 06:00:00'"))
    return T.discover_partitions(T.partitions(m), seen)


@check(
    "topics_difference",
    f"""WITH a AS (SELECT DISTINCT CAST(user_id % 64 AS INTEGER) AS partition FROM events WHERE ts < TIMESTAMP '2024-01-01 06:00:00'),
    b AS (SELECT DISTINCT CAST(user_id % 64 AS INTEGER) AS partition FROM events WHERE ts >= TIMESTAMP '2024-01-30 18:00:00')
    SELECT '{EVENTS}' AS topic, partition, 'gone' AS change FROM a WHERE partition NOT IN (SELECT partition FROM b)
    UNION ALL SELECT '{EVENTS}', partition, 'added' FROM b WHERE partition NOT IN (SELECT partition FROM a)""",
)
def topics_difference(spark, folder):
    m = events(spark, folder).withColumn("partition", (F.col("key").cast("string").cast("bigint") % 64).cast("int"))
    before = T.partitions(m.where("publish_time < TIMESTAMP '2024-01-01 06:00:00'"))
    after = T.partitions(m.where("publish_time >= TIMESTAMP '2024-01-30 18:00:00'"))
    return T.topic_diff(before, after)


@check(
    "data_loss_guard",
    f"""WITH {EV}, mark AS (SELECT partition, MAX(event_id) AS last FROM ev GROUP BY 1),
    s AS (SELECT partition, last, last // 1000 AS ledger_id, last % 1000 + partition AS entry_id FROM mark),
    p AS (SELECT *, UNNEST(['earliest', 'last']) AS policy FROM s)
    SELECT policy, partition,
      CASE WHEN partition < 2 THEN ledger_id WHEN policy = 'last' THEN last // 1000 END AS ledger_id,
      CASE WHEN partition < 2 THEN entry_id WHEN policy = 'last' THEN last % 1000 END AS entry_id,
      partition >= 2 AS inclusive FROM p""",
)
def data_loss_guard(spark, folder):
    marks = S.high_water(events(spark, folder))
    asked = F.struct(
        F.col("last.ledger_id"), (F.col("last.entry_id") + F.col("partition")).alias("entry_id"), F.lit(-1).alias("batch_index")
    )
    starts = marks.select(*LOG, asked.alias("start"), F.lit(False).alias("inclusive"))
    out = [
        S.guard_data_loss(starts, marks, policy).select(
            F.lit(policy).alias("policy"), "partition", "start.ledger_id", "start.entry_id", "inclusive"
        )
        for policy in ("earliest", "last")
    ]
    return out[0].unionByName(out[1])


@check(
    "key_range_scan",
    f"WITH {EV}, {MURMUR} SELECT {ROW} FROM ev JOIN murmur USING (key) WHERE (hash & 65535) BETWEEN 16384 AND 32767",
)
def key_range_scan(spark, folder):
    return _rows(T.key_range_scan(events(spark, folder), 4, 1))


@check(
    "distribute_range",
    f"""WITH {EV}, {MURMUR},
    r AS (SELECT CAST(i AS INTEGER) AS reader, CAST(i * 9362 + LEAST(i, 2) AS INTEGER) AS range_start,
      CAST((i + 1) * 9362 + LEAST(i + 1, 2) - 1 AS INTEGER) AS range_end FROM range(7) t(i)),
    c AS (SELECT (hash & 65535) AS slot FROM ev JOIN murmur USING (key))
    SELECT reader, range_start, range_end, COUNT(slot) AS messages
    FROM r LEFT JOIN c ON slot BETWEEN range_start AND range_end GROUP BY ALL""",
)
def distribute_range(spark, folder):
    counts = events(spark, folder).groupBy(T.reader_of_slot(key_slot(F.col("key")), 7).alias("reader")).count()
    return T.key_ranges(spark, 7).join(counts, "reader", "left").select(
        "reader", "range_start", "range_end", F.coalesce("count", F.lit(0)).alias("messages")
    )


@check(
    "assign_partitions",
    """WITH parts AS (
      SELECT DISTINCT 'persistent://public/default/events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition FROM events
      UNION SELECT DISTINCT 'persistent://public/default/orders', CAST(o_custkey % 4 AS INTEGER) FROM orders
      UNION SELECT DISTINCT 'persistent://public/default/lineitem', CAST(l_orderkey % 8 AS INTEGER) FROM lineitem
      UNION SELECT DISTINCT 'persistent://public/default/plain-' || r_name, -1 FROM region),
    h AS (SELECT topic, partition, list_reduce(list_transform(string_split(topic, ''), lambda c: CAST(ord(c) AS BIGINT)),
      lambda acc, c: (acc * 31 + c) & 4294967295, CAST(0 AS BIGINT)) AS hash FROM parts)
    SELECT topic, partition, CAST((((hash * 31) & 2147483647) % 3 + GREATEST(partition, 0)) % 3 AS INTEGER) AS reader FROM h""",
)
def assign_partitions(spark, folder):
    from topiclake.checks.topics import table

    plain = table(spark, folder, "region").select(
        F.concat(F.lit("persistent://public/default/plain-"), "r_name").alias("topic"), F.lit(-1).alias("partition")
    )
    parts = T.partitions(log(spark, folder).unionByName(lineitem(spark, folder))).unionByName(plain.distinct())
    return T.assign_partitions(parts, 3)


@check(
    "skip_corrupt",
    f"""WITH {EV} SELECT partition, COUNT(*) FILTER (WHERE event_id % 17 <> 0) AS emitted, COUNT(*) AS passed,
    MAX(event_id) // 1000 AS ledger_id, MAX(event_id) % 1000 AS entry_id FROM ev WHERE NOT tombstone GROUP BY 1""",
)
def skip_corrupt(spark, folder):
    broken = F.when(F.col("sequence_id") % 17 == 0, F.lit(b'{"event_id": ')).otherwise(F.col("value"))
    m = events(spark, folder).where("value IS NOT NULL").withColumn("value", broken)
    emitted = S.drop_undecodable(decode(m, "event_id BIGINT"), "data.event_id").groupBy("partition").agg(F.count("*").alias("emitted"))
    # positions come from all messages, also from those that do not decode
    passed = S.high_water(m).select("partition", "last.ledger_id", "last.entry_id")
    total = m.groupBy("partition").agg(F.count("*").alias("passed"))
    return total.join(emitted, "partition").join(passed, "partition").select(
        "partition", "emitted", "passed", "ledger_id", "entry_id"
    )


@check(
    "stop_at_marker",
    f"""WITH {EV}, stop AS (SELECT partition, MIN(event_id) AS stop FROM ev WHERE event_type = 'purchase' AND event_id % 100 >= 90 GROUP BY 1)
    SELECT {ROW} FROM ev LEFT JOIN stop USING (partition) WHERE stop IS NULL OR event_id < stop""",
)
def stop_at_marker(spark, folder):
    marker = (F.col("properties")["type"] == "purchase") & (F.col("sequence_id") % 100 >= 90)
    return _rows(S.until_marker(events(spark, folder), marker))


def _stored_events(spark, folder):
    """Events in three commits, of which the last two overlap, and the messages themselves."""
    path, m = new_dir(spark, "stored"), events(spark, folder)
    part = F.when(F.col("publish_time") < F.expr(CUT), 0).otherwise(1 + F.col("sequence_id") % 2)
    for i in range(3):
        write(m.where(part == i), path, commit=f"{i}")
    return path, m


@check(
    "stored_positions",
    f"WITH {EV} SELECT topic, partition, MAX(event_id) // 1000 AS ledger_id, MAX(event_id) % 1000 AS entry_id, -1 AS batch_index FROM ev GROUP BY 1, 2",
)
def stored_positions(spark, folder):
    """Last positions from what the commits keep; no message is read."""
    path, _ = _stored_events(spark, folder)
    return M.positions(M.files(spark, path))


@check(
    "stored_backlog",
    f"""WITH {EV}, cur AS (SELECT partition, MAX(event_id) - 150 AS last FROM ev WHERE partition < 3 GROUP BY 1)
    SELECT topic, partition, COUNT(CASE WHEN last IS NULL OR event_id > last THEN 1 END) AS backlog, COUNT(*) AS messages FROM ev LEFT JOIN cur USING (partition) GROUP BY 1, 2""",
)
def stored_backlog(spark, folder):
    """Messages after cursors that stand inside files: only those files are read."""
    path, m = _stored_events(spark, folder)
    at = m.where("partition < 3").groupBy(*LOG).agg((F.max("sequence_id") - 150).alias("last"))
    cursors = at.select(*LOG, F.expr("last DIV 1000").alias("ledger_id"), F.pmod("last", F.lit(1000)).alias("entry_id"), F.lit(-1).alias("batch_index"))
    return M.backlog(spark, path, M.files(spark, path), cursors)


@check(
    "resume_lagging_partition",
    f"""WITH {EV}, lagging AS (SELECT *, user_id % 64 AS part FROM ev), mark AS (SELECT part, MAX(event_id) AS last FROM lagging WHERE publish_time < {CUT} GROUP BY 1)
    SELECT CAST(part AS INTEGER) AS partition, sequence_id FROM lagging LEFT JOIN mark USING (part) WHERE part = 7 OR last IS NULL OR event_id > last""",
)
def resume_lagging_partition(spark, folder):
    """64 partitions read on from saved positions, one of them from its beginning: of the others no earlier file is read."""
    path = new_dir(spark, "stored")
    m = events(spark, folder).withColumn("partition", (F.col("key").cast("string").cast("bigint") % 64).cast("int"))
    early = F.col("publish_time") < F.expr(CUT)
    for i, part in enumerate((m.where(early), m.where(~early))):
        write(part, path, commit=f"{i}")
    saved = S.high_water(m.where(early)).select(*LOG, F.when(F.col("partition") != 7, F.col("last")).alias("start"), F.lit(False).alias("inclusive"))
    return S.from_starts(read_log(spark, path), saved).select("partition", "sequence_id")
