from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

from helpers import at, messages, rows
from topiclake.catalog.connect import (
    insert_into,
    insert_messages,
    insert_stream,
    read_changelog,
    read_changelog_stream,
    read_table,
    read_table_stream,
)
from topiclake.catalog.options import TableOptions
from topiclake.operators import cursors as K
from topiclake.sources import starts as S
from topiclake.sources.topics import partitions, read_log


def options(ddl, opts, **more):
    return TableOptions(T.StructType.fromDDL(ddl), {"topic": "t", "format": "json", **opts}, **more)


@pytest.fixture
def log(spark):
    return messages(spark, [(i % 2, i, f"k{i % 3}", f'{{"v": {i}}}', i) for i in range(12)])


@pytest.mark.parametrize(
    "opts, want",
    [
        ({"scan.startup.mode": "earliest"}, list(range(12))),
        ({}, []),
        ({"scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": "1704067207000"}, list(range(7, 12))),
        ({"scan.startup.mode": "specific-offsets", "scan.startup.specific-offsets": "0:8:0;0:5:1"}, [5, 7, 8, 9, 10, 11]),
        ({"topic-pattern": "t.*", "topic": None, "scan.startup.mode": "earliest"}, list(range(12))),
    ],
)
def test_startup_from_options(log, opts, want):
    merged = {k: v for k, v in {"topic": "t", "format": "json", **opts}.items() if v is not None}
    table = TableOptions(T.StructType.fromDDL("v INT"), merged)
    assert rows(read_table(log, table), "v") == [(v,) for v in want]


def test_formats_of_one_column(spark, log):
    raw = options("line STRING", {"format": "raw", "scan.startup.mode": "earliest"})
    assert read_table(log, raw).first().line.startswith('{"v"')
    rows_in = spark.range(5).select((F.col("id") * 7).cast("int").alias("n"))
    atomic = options("n INT", {"format": "atomic", "scan.startup.mode": "earliest"})
    assert rows(read_table(insert_messages(rows_in, atomic, F.col("n")), atomic), "n") == [(i * 7,) for i in range(5)]


def test_key_and_value_own_the_same_field(spark, path):
    table = options(
        "k_id INT, id INT, name STRING",
        {
            "key.format": "json", "key.fields": "k_id", "key.fields-prefix": "k_", "value.fields-include": "EXCEPT_KEY",
            "scan.startup.mode": "earliest", "sink.parallelism": "2",
        },
    )
    where = path("table")
    data = spark.createDataFrame([(1, 10, "a"), (2, 20, None)], table.schema)
    insert_into(data, where, table, F.col("id"))
    stored = read_log(spark, where)
    assert rows(stored.select(F.col("key").cast("string").alias("key")), "key") == [('{"id":1}',), ('{"id":2}',)]
    assert rows(read_table(stored, table), *table.schema.names) == rows(data, *table.schema.names)


def test_insert_rules(spark):
    table = options("v INT", {"properties.send-delay-millisecond": "5000"})
    df = spark.createDataFrame([(1, at(0))], "v INT, eventTime TIMESTAMP")
    message = insert_messages(df, table, F.col("v"), publish_time=F.lit(at(1))).first()
    assert (message.deliver_at, message.event_time) == (at(6), at(0))
    with pytest.raises(ValueError, match="read-only"):
        insert_messages(df.withColumnRenamed("eventTime", "publishTime"), table, F.col("v"))
    with pytest.raises(ValueError, match="single topic"):
        insert_messages(df, options("v INT", {"topic": "a;b"}), F.col("v"))


def test_upsert_table_round_trip(spark, path):
    table = options("id STRING, v INT", {"value.fields-include": "EXCEPT_KEY"}, primary_key=["id"], upsert=True)
    changes = spark.createDataFrame(
        [("+I", "a", 1, 0), ("+I", "b", 2, 1), ("-U", "a", 1, 2), ("+U", "a", 3, 3), ("-D", "b", 2, 4), ("+I", "c", 5, 5)],
        "row_kind STRING, id STRING, v INT, n BIGINT",
    )
    where = path("upsert")
    insert_into(changes, where, table, F.col("n"), partitions=3)
    log = read_log(spark, where)
    assert log.where("value IS NULL").count() == 2
    assert rows(read_table(log, table), "id", "v") == [("a", 3), ("c", 5)]
    # the tombstone of the -U row makes the update a delete and an insert
    got = [tuple(r) for r in read_changelog(log, table).orderBy("_entry_id", "step").select("row_kind", "id", "v").collect()]
    assert got == [("+I", "a", 1), ("+I", "b", 2), ("-D", "a", 1), ("+I", "a", 3), ("-D", "b", 2), ("+I", "c", 5)]
    with pytest.raises(ValueError):
        read_changelog(log, options("v INT", {}))


def test_new_cursors_stand_before_the_start(spark, log, path):
    where = path("cursors")
    K.commit_cursors(K.commit_rows(S.high_water(log.where("partition = 0 AND entry_id < 6")).select("topic", "partition", "last.*"), "s", 0), where)
    cursors = K.current_cursors(K.read_cursors(spark, where))
    starts = S.earliest_starts(partitions(log))
    fresh = S.new_cursors(starts, cursors, "s")
    assert rows(fresh, "partition", "entry_id") == [(1, -1)]
    K.commit_cursors(K.commit_rows(fresh, "s", 1), where)
    now = K.current_cursors(K.read_cursors(spark, where))
    rest = S.with_start(log, "external-subscription", cursors=now, subscription="s")
    assert rows(rest, "entry_id") == [(i,) for i in (1, 3, 5, 6, 7, 8, 9, 10, 11)]
    given = S.position_rows(spark, {("x", 0): (4, 7), ("x", 1): (4, 0)})
    assert rows(S.new_cursors(given, cursors, "s"), "partition", "ledger_id", "entry_id") == [(0, 4, 6), (1, 4, -1)]


def test_unknown_options_are_refused():
    with pytest.raises(ValueError, match="scan.startup.mod'"):
        options("n INT", {"format": "atomic", "scan.startup.mod": "earliest"})


def test_no_column_is_dropped(spark, path):
    two = options("a INT, b STRING", {"format": "raw"})
    frame = spark.createDataFrame([(1, "x")], "a INT, b STRING")
    with pytest.raises(ValueError, match="one column"):
        insert_messages(frame, two, F.lit(0))
    keyed = options("a INT, b STRING, c INT", {"format": "json", "key.format": "raw", "key.fields": "a;b"})
    with pytest.raises(ValueError, match="one column"):
        insert_messages(frame.withColumn("c", F.lit(1)), keyed, F.lit(0))


def test_positions_of_two_inserts_differ(spark, path):
    where, one = path(), options("a INT", {"format": "json", "scan.startup.mode": "earliest"})
    for _ in range(2):
        insert_into(spark.createDataFrame([(1,), (2,)], "a INT"), where, one, F.col("a"))
    log = read_log(spark, where)
    assert log.select("ledger_id", "entry_id").distinct().count() == 4
    assert read_table(log, one).count() == 4


def test_lost_data_stops_a_read(spark, log):
    beyond = {"format": "json", "scan.startup.mode": "specific-offsets", "scan.startup.specific-offsets": "99:99:0"}
    with pytest.raises(Exception, match="beyond the last message"):
        read_table(log, options("v INT", beyond)).collect()
    assert read_table(log, options("v INT", {**beyond, "failondataloss": "false"})).count() >= 0


def test_a_stream_from_options_starts_at_latest(spark, path):
    where, state, checkpoint, out = path(), path("state"), path("checkpoint"), path("out")
    table = options("v INT", {"format": "json", "fail-on-write": "false", "sink.semantic": "exactly-once"})

    def go():
        rows_read = read_table_stream(spark, where, table, state)
        insert_stream(rows_read, out, options("v INT", {"sink.semantic": "exactly-once"}), F.col("v"), checkpoint).awaitTermination()

    insert_into(spark.createDataFrame([(1,), (2,)], "v INT"), where, table, F.col("v"))
    insert_into(spark.createDataFrame([(7,)], "v INT"), out, table, F.col("v"))
    go()
    insert_into(spark.createDataFrame([(3,)], "v INT"), where, table, F.col("v"))
    go()
    found = read_table(read_log(spark, out), options("v INT", {"scan.startup.mode": "earliest"}))
    assert rows(found, "v") == [(3,), (7,)]
    with pytest.raises(ValueError, match="normalize_stream"):
        read_table_stream(spark, where, options("v INT", {}, primary_key=["v"], upsert=True), state)


def test_an_upsert_table_as_a_stream(spark, path):
    """The changelog from options alone: what the batch gives, from two micro-batches and a restart."""
    table = options("id STRING, v INT", {"value.fields-include": "EXCEPT_KEY", "scan.startup.mode": "earliest"}, primary_key=["id"], upsert=True)
    where, out, state, checkpoint = path("upsert"), path("out"), path("state"), path("checkpoint")
    emit = lambda df, n: df.write.mode("overwrite").parquet(f"{out}/part={n}")
    for i in range(3):
        data = [("+U", f"k{j % 4}", i * j, j) if (i + j) % 5 else ("-D", f"k{j % 4}", None, j) for j in range(7)]
        insert_into(spark.createDataFrame(data, "row_kind STRING, id STRING, v INT, n BIGINT"), where, table, F.col("n"), partitions=1)
        if i:
            read_changelog_stream(spark, where, table, state, checkpoint, emit, files_per_batch=1).awaitTermination()
    columns = ["row_kind", "id", "v", "_ledger_id", "_entry_id", "step"]
    assert rows(spark.read.parquet(out), *columns) == rows(read_changelog(read_log(spark, where), table), *columns)
    with pytest.raises(ValueError, match="only an upsert table"):
        read_changelog_stream(spark, where, options("v INT", {}), state, checkpoint, emit)
    with pytest.raises(ValueError, match="read_changelog_stream"):
        read_table_stream(spark, where, table, state)


def test_schema_rules_hold_for_writers_and_streams(spark, path):
    from topiclake.catalog import registry as R

    table, other = options("v INT", {"scan.startup.mode": "earliest"}), options("v STRING", {"scan.startup.mode": "earliest"})
    known = R.register_schema(R.empty_registry(spark), "persistent://public/default/t", table.schema, "JSON")
    where, data = path("log"), spark.createDataFrame([(1,)], "v INT")
    assert insert_into(data, where, table, F.col("v"), registry=known)
    with pytest.raises(R.IncompatibleSchema):
        insert_into(data.select(F.col("v").cast("string")), where, other, F.lit(1), registry=known)
    assert read_log(spark, where).count() == 1
    both = options("v INT", {"topic": "t;u", "scan.startup.mode": "earliest"})
    assert read_table_stream(spark, where, table, path("state"), registry=known).isStreaming
    with pytest.raises(R.IncompatibleSchema):
        read_table_stream(spark, where, both, path("state"), registry=known)


@pytest.mark.parametrize("default", ["latest", "earliest"])
def test_a_first_read_leaves_cursors(spark, path, default):
    table = options("v INT", {"scan.startup.mode": "external-subscription", "scan.startup.sub-name": "s", "scan.startup.sub-start-offset": default})
    where, cursors = path("log"), path("cursors")

    def more(low, high):
        insert_into(spark.range(low, high).select(F.col("id").cast("int").alias("v")), where, table, F.col("v"), partitions=1)

    def read():
        return [v for (v,) in rows(read_table(read_log(spark, where), table, cursor_path=cursors), "v")]

    more(0, 3)
    assert read() == ([] if default == "latest" else [0, 1, 2])
    # what comes after the first read is after the cursor, also when that stands at the last message
    more(3, 5)
    assert read() == ([3, 4] if default == "latest" else [0, 1, 2, 3, 4])
    assert K.current_cursors(K.read_cursors(spark, cursors)).count() == 1
