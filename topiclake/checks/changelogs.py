"""Queries: keyed topics as changelogs and tables, and joins with them."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from topiclake.checks import check
from topiclake.checks.topics import EV, event_rows, events, ntz, table, user_id
from topiclake.operators import changelog as C
from topiclake.operators.decode import decode
from topiclake.operators.sinks import upsert_messages, write, write_upsert
from topiclake.operators.temporal import as_of_join, intervals
from topiclake.plans.workspace import new_dir
from topiclake.sources import snapshots
from topiclake.sources.topics import read_log, scan

DDL = "event_type STRING, value DOUBLE"
COLUMNS = ["event_type", "value"]
#: parts in which documents arrive
UPDATES = 8
#: SQL: what `normalize` gives for the events topic, one row per change
NORMAL = f"""{EV}, seen AS (
  SELECT user_id, event_id, tombstone, event_type, value,
    LAG(event_id) OVER w AS prev_id, COALESCE(LAG(tombstone) OVER w, TRUE) AS prev_gone,
    LAG(event_type) OVER w AS prev_type, LAG(value) OVER w AS prev_value
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
normal AS (
  SELECT '-D' AS row_kind, user_id, prev_type AS event_type, prev_value AS value, event_id, 0 AS step
    FROM seen WHERE tombstone AND NOT prev_gone
  UNION ALL SELECT '+I', user_id, event_type, value, event_id, 0 FROM seen WHERE NOT tombstone AND prev_gone
  UNION ALL SELECT '-U', user_id, prev_type, prev_value, event_id, 0 FROM seen
    WHERE NOT tombstone AND NOT prev_gone AND (event_type <> prev_type OR value <> prev_value)
  UNION ALL SELECT '+U', user_id, event_type, value, event_id, 1 FROM seen
    WHERE NOT tombstone AND NOT prev_gone AND (event_type <> prev_type OR value <> prev_value))"""
LAST = """last AS (SELECT user_id, MAX(event_id) AS event_id FROM ev GROUP BY 1)"""


def changes(spark, folder):
    return C.decode_upsert(events(spark, folder), {"user_id": user_id()}, DDL)


def full(spark, folder):
    """The normalised changelog, with the event id that positions stand for."""
    return C.normalize(changes(spark, folder), ["user_id"], columns=COLUMNS).withColumn(
        "event_id", F.col("ledger_id") * 1000 + F.col("entry_id")
    )


@check(
    "decode_upsert",
    f"""WITH {EV} SELECT CASE WHEN tombstone THEN '-D' ELSE '+U' END AS row_kind, user_id,
    CASE WHEN NOT tombstone THEN event_type END AS event_type, CASE WHEN NOT tombstone THEN value END AS value, event_id FROM ev""",
)
def decode_upsert(spark, folder):
    return changes(spark, folder).select(
        "row_kind", "user_id", "event_type", "value", (F.col("ledger_id") * 1000 + F.col("entry_id")).alias("event_id")
    )


@check("changelog_normalize", f"WITH {NORMAL} SELECT * FROM normal")
def changelog_normalize(spark, folder):
    return full(spark, folder).select("row_kind", "user_id", "event_type", "value", "event_id", "step")


@check(
    "materialize_latest",
    f"WITH {EV}, {LAST} SELECT user_id, event_type, value FROM ev JOIN last USING (user_id, event_id) WHERE NOT tombstone",
)
def materialize_latest(spark, folder):
    return C.latest_table(events(spark, folder), {"user_id": user_id()}, DDL).select("user_id", "event_type", "value")


@check(
    "materialize_snapshot",
    f"WITH {EV}, {LAST} SELECT user_id, event_type, value FROM ev JOIN last USING (user_id, event_id) WHERE NOT tombstone",
)
def materialize_snapshot(spark, folder):
    """The current table of a stored log, from a snapshot of its first three commits, made in two steps, and the commits since."""
    path, m = new_dir(spark, "log"), events(spark, folder)
    for i in range(5):
        write(m.where(F.expr(f"sequence_id % 5 = {(i * 2) % 5}")), path, commit=f"{i}")
        if i in (0, 2):
            snapshots.refresh(spark, path)
    rows = C.latest_table(snapshots.last_messages(spark, path), {"user_id": user_id()}, DDL)
    return rows.select("user_id", "event_type", "value")


@check(
    "materialize_as_of",
    f"""WITH {EV}, last AS (SELECT user_id, MAX(event_id) AS event_id FROM ev WHERE publish_time <= TIMESTAMP '2024-01-15' GROUP BY 1)
    SELECT user_id, event_type, value FROM ev JOIN last USING (user_id, event_id) WHERE NOT tombstone""",
)
def materialize_as_of(spark, folder):
    until = F.col("publish_time") <= "2024-01-15"
    return C.latest_as_of(changes(spark, folder), ["user_id"], until).select("user_id", "event_type", "value")


@check(
    "encode_upsert",
    f"""WITH {NORMAL} SELECT user_id, event_id, step, row_kind IN ('-D', '-U') AS tombstone,
    CASE WHEN row_kind NOT IN ('-D', '-U') THEN value END AS value FROM normal""",
)
def encode_upsert(spark, folder):
    m = C.encode_upsert(full(spark, folder), ["user_id"], ["event_type", "value"], keep=["event_id", "step"])
    keyed = decode(m, "user_id BIGINT", column="key", into="k").withColumn("tombstone", F.col("value").isNull())
    return decode(keyed, DDL).select("k.user_id", "event_id", "step", "tombstone", "data.value")


@check(
    "upsert_sink",
    f"""WITH {EV}, {LAST} SELECT user_id, event_type, value, 1 AS partitions FROM ev JOIN last USING (user_id, event_id) WHERE NOT tombstone""",
)
def upsert_sink(spark, folder):
    """Write the normalised changelog to a keyed topic and read the table back."""
    path = new_dir(spark, "upsert")
    write_upsert(
        full(spark, folder), path, topic="users", pk=["user_id"], columns=["user_id", *COLUMNS],
        sequence=F.col("event_id") * 2 + F.col("step"), partitions=4, publish_time=F.col("publish_time"),
    )
    m = scan(read_log(spark, path), topic="users")
    key = F.get_json_object(F.col("key").cast("string"), "$.user_id").cast("bigint")
    rows = C.decode_upsert(m, {"user_id": key}, DDL)
    homes = m.groupBy(key.alias("user_id")).agg(F.count_distinct("partition").cast("int").alias("partitions"))
    return C.latest(rows, ["user_id"]).join(homes, "user_id").select("user_id", "event_type", "value", "partitions")


@check(
    "compact_log",
    f"WITH {EV}, {LAST} SELECT key, sequence_id, partition, value FROM ev JOIN last USING (user_id, event_id) WHERE NOT tombstone",
)
def compact_log(spark, folder):
    m = event_rows(C.compact(events(spark, folder)))
    return m.select(F.col("key").cast("string").alias("key"), "sequence_id", "partition", "data.value")


def _word_counts(spark, folder):
    words = table(spark, folder, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy(F.lower("word").alias("word")).agg(F.count("*").alias("count"))


def _word_count_changes(spark, folder):
    """The counts per word as upserts: documents arrive in UPDATES parts, and each part updates its words."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(UPDATES)).alias("update")
    words = table(spark, folder, "documents").select(part, F.explode(F.split("text", " ")).alias("word"))
    counts = words.groupBy(F.lower("word").alias("word"), "update").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("word").orderBy("update"))
    return counts.select(F.lit("+U").alias("row_kind"), "word", so_far.alias("n"), "update")


_WORDS = "w AS (SELECT LOWER(word) AS word, COUNT(*) AS count FROM (SELECT UNNEST(string_split(text, ' ')) AS word FROM documents) GROUP BY 1)"


@check("grouped_count_upsert", f"WITH {_WORDS} SELECT word, count FROM w")
def grouped_count_upsert(spark, folder):
    """Counts per word, through the messages of an upsert topic and back."""
    counts = _word_counts(spark, folder).withColumn("row_kind", F.lit("+U"))
    m = upsert_messages(
        counts, topic="word-count", pk=["word"], columns=["word", "count"], sequence=F.col("count"), partitions=4
    )
    rows = C.decode_upsert(m, {"word": F.get_json_object(F.col("key").cast("string"), "$.word")}, "count BIGINT")
    return C.latest(rows, ["word"]).select("word", "count")


@check("count_of_counts_having", f"WITH {_WORDS} SELECT count, COUNT(*) AS words FROM w GROUP BY 1 HAVING COUNT(*) < 2")
def count_of_counts_having(spark, folder):
    """Words per count, by adding and retracting the changes of counts that are updated several times."""
    full = C.normalize(_word_count_changes(spark, folder), ["word"], ["update"], ["n"])
    return C.count_change(full, ["n"]).select(F.col("n").alias("count"), F.col("count").alias("words")).where("words < 2")


@check(
    "changelog_retraction",
    f"WITH {EV}, {LAST} SELECT event_type, COUNT(*) AS count FROM ev JOIN last USING (user_id, event_id) WHERE NOT tombstone GROUP BY 1",
)
def changelog_retraction(spark, folder):
    """Current rows per group, by adding and retracting the changes of the changelog."""
    return C.count_change(full(spark, folder), ["event_type"])


# temporal joins -----------------------------------------------------------------------

_SIDES = """views AS (SELECT event_id AS view_id, user_id, ts AS view_time FROM events WHERE event_type = 'view'),
versions AS (SELECT user_id, ts AS version_time, event_id AS version_id, value AS price, event_type = 'error' AS deleted
  FROM events WHERE event_type IN ('purchase', 'error')),
joined AS (SELECT view_id, v.user_id, view_time, version_time, version_id, price, deleted
  FROM views v ASOF LEFT JOIN versions r ON v.user_id = r.user_id AND v.view_time >= r.version_time)"""


def _sides(spark, folder):
    e = table(spark, folder, "events")
    views = e.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_time"))
    versions = e.where("event_type IN ('purchase', 'error')").select(
        "user_id",
        F.col("ts").alias("version_time"),
        F.col("event_id").alias("version_id"),
        F.col("value").alias("price"),
        (F.col("event_type") == "error").alias("deleted"),
    )
    return views, versions


def temporal_join(spark, folder, how, **more):
    views, versions = _sides(spark, folder)
    return as_of_join(
        views, versions, ["user_id"], "view_time", "version_time", how, right_order=["version_id"], deleted="deleted", **more
    )


@check(
    "temporal_left_join",
    f"""WITH {_SIDES} SELECT view_id, user_id, view_time, CASE WHEN NOT deleted THEN version_time END AS version_time,
      CASE WHEN NOT deleted THEN version_id END AS version_id, CASE WHEN NOT deleted THEN price END AS price FROM joined""",
)
def temporal_left_join(spark, folder):
    """With versions that grow with the log: one shuffle of both sides."""
    return temporal_join(spark, folder, "left", broadcast_versions=0)


@check("temporal_inner_join", f"WITH {_SIDES} SELECT * EXCLUDE (deleted) FROM joined WHERE NOT deleted")
def temporal_inner_join(spark, folder):
    return temporal_join(spark, folder, "inner", broadcast_versions=0)


@check("temporal_join_few_versions", f"WITH {_SIDES} SELECT * EXCLUDE (deleted) FROM joined WHERE NOT deleted")
def temporal_join_few_versions(spark, folder):
    """The same with a broadcast of the versions, as long as they are few."""
    return temporal_join(spark, folder, "inner")


@check(
    "version_intervals",
    f"""WITH {EV}, s AS (SELECT *, LEAD(publish_time) OVER (PARTITION BY user_id ORDER BY event_id) AS next_time FROM ev)
    SELECT user_id, event_type, value, publish_time AS valid_from, next_time AS valid_to FROM s WHERE NOT tombstone""",
)
def version_intervals(spark, folder):
    rows = intervals(changes(spark, folder), ["user_id"], "publish_time", ["ledger_id", "entry_id"])
    return rows.select("user_id", "event_type", "value", ntz("valid_from").alias("valid_from"), ntz("valid_to").alias("valid_to"))
