from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from helpers import messages, rows
from topiclake.operators import cursors as K
from topiclake.operators.cursors import SENTINEL_LEDGERS
from topiclake.sources import starts as S, topics as T

TOPIC = "persistent://public/default/t"


@pytest.fixture(scope="module")
def log(spark):
    # three partitions, nine numbers each
    return messages(spark, [(p, e, f"k{e}", str(e), e) for p in range(3) for e in range(9)])


def test_topic_options(log):
    for bad in ({}, {"topic": "a", "topics": "b"}, {"topic": "a,b"}, {"topics": " , "}, {"pattern": " "}):
        with pytest.raises(ValueError):
            T.scan(log, **bad)


def test_pattern_matches_in_full_and_in_one_namespace(spark):
    names = ["persistent://a/b/x1", "persistent://a/b/x1y", "persistent://a/c/x1", "persistent://a/b/zx1"]
    log = spark.createDataFrame([(n,) for n in names], "topic STRING")
    assert [r.topic for r in T.scan(log, pattern=r"a/b/x\d").collect()] == ["persistent://a/b/x1"]
    assert T.scan(log, pattern="a/b/x.*").count() == 2


def test_specific_is_inclusive_and_the_rest_is_latest(log):
    got = S.with_start(log, "specific-offsets", positions={(TOPIC, 0): (0, 3), (TOPIC, 1): (0, 8)})
    assert rows(got, "partition", "entry_id") == [(0, e) for e in range(3, 9)] + [(1, 8)]


def test_specific_refuses_unknown_partitions(log):
    with pytest.raises(ValueError, match="do not exist"):
        S.with_start(log, "specific-offsets", positions={(TOPIC, 9): (0, 3)})


def test_latest_and_new_partitions(log):
    marks = S.high_water(log.where("entry_id < 5 AND partition < 2"))
    got = S.with_start(log, "latest", marks=marks)
    # partition 2 was found later and is read from its first message
    assert rows(got, "partition", "entry_id") == [(p, e) for p in (0, 1) for e in range(5, 9)] + [(2, e) for e in range(9)]
    assert S.with_start(log, "latest").count() == 0


def test_captured_marks_do_not_move(log, path):
    where = path("marks")
    first = S.captured_marks(log.where("entry_id < 4"), where)
    assert rows(first, "partition", "last.entry_id") == [(0, 3), (1, 3), (2, 3)]
    assert rows(S.captured_marks(log, where), "partition", "last.entry_id") == [(0, 3), (1, 3), (2, 3)]


def test_timestamp_bounds(log):
    for bad in (-1, None, int(time.time() * 1000) + 10**9):
        with pytest.raises(ValueError):
            S.with_start(log, "timestamp", timestamp_ms=bad)
    assert S.with_start(log, "timestamp", timestamp_ms=0).count() == 27


def test_subscription(spark, log):
    cursors = spark.createDataFrame(
        [("s", TOPIC, 0, 0, 4, -1, False), ("s", TOPIC, 1, 0, -1, -1, False), ("other", TOPIC, 2, 0, 0, -1, True)],
        "subscription STRING, topic STRING, partition INT, ledger_id BIGINT, entry_id BIGINT, batch_index INT, active BOOLEAN",
    )
    got = S.with_start(log, "external-subscription", cursors=cursors, subscription="s")
    # after entry 4; nothing read yet; no cursor, so latest
    assert rows(got, "partition", "entry_id") == [(0, e) for e in range(5, 9)] + [(1, e) for e in range(9)]
    early = S.with_start(log, "external-subscription", cursors=cursors, subscription="s", default="earliest")
    assert early.where("partition = 2").count() == 9
    with pytest.raises(RuntimeError, match="another consumer"):
        S.with_start(log, "external-subscription", cursors=cursors, subscription="other")
    with pytest.raises(ValueError):
        S.with_start(log, "external-subscription")


def test_unknown_mode(log):
    with pytest.raises(ValueError):
        S.with_start(log, "newest")


def test_resume(log):
    saved = S.high_water(log.where("entry_id <= 5 AND partition = 0")).withColumnRenamed("last", "start")
    gone = saved.withColumn("topic", F.lit("persistent://public/default/gone"))
    parts = T.partitions(log)
    starts = S.resolve_start(parts, saved.unionByName(gone), S.latest_starts(S.high_water(log)))
    assert starts.count() == 3
    assert rows(S.from_starts(log, starts), "partition", "entry_id") == [(0, e) for e in (6, 7, 8)]


def test_data_loss(spark, log):
    marks = S.high_water(log)
    starts = S.position_rows(spark, {(TOPIC, 0): (0, 9), (TOPIC, 1): (0, 10), (TOPIC, 2): (7, -1)})
    # last + 1 is the next message and valid; an entry of -1 always is
    for policy, count in (("earliest", 9), ("last", 1)):
        got = S.from_starts(log, S.guard_data_loss(starts, marks, policy))
        assert got.groupBy("partition").count().collect() == [(1, count)]
    with pytest.raises(Exception, match="beyond the last message"):
        S.guard_data_loss(starts, marks, "fail").collect()
    with pytest.raises(ValueError):
        S.guard_data_loss(starts, marks, "ignore")


def test_marker_stops_only_its_partition(log):
    got = S.until_marker(log, (F.col("partition") == 1) & (F.col("entry_id") % 5 == 3))
    assert got.groupBy("partition").count().orderBy("partition").collect() == [(0, 9), (1, 3), (2, 9)]


def test_batched_positions(spark):
    m = messages(spark, [(0, e, "k", "v", e) for e in range(3)]).withColumn(
        "batch_index", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    )
    last = S.high_water(m).first()["last"]
    assert tuple(last) == (0, 2, 2)
    got = S.with_start(m, "specific-offsets", positions={(TOPIC, 0): (0, 1, 2)})
    assert rows(got, "entry_id", "batch_index") == [(1, 2), (2, 0), (2, 1), (2, 2)]


@pytest.mark.parametrize("readers", [1, 2, 3, 4, 7, 1000, 1999, 65536])
def test_ranges_cover_the_ring(spark, readers):
    ranges = sorted(T.key_range(readers, i) for i in range(readers))
    assert ranges[0][0] == 0 and ranges[-1][1] == 65535
    assert all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:]))
    if readers < 100:
        table = T.key_ranges(spark, readers)
        assert rows(table, "range_start", "range_end") == ranges
        slots = spark.range(0, 65536, 97).select(F.col("id").alias("slot"), T.reader_of_slot(F.col("id"), readers).alias("reader"))
        wrong = slots.join(table, "reader").where(~F.col("slot").between(F.col("range_start"), F.col("range_end")))
        assert wrong.count() == 0


def test_known_ranges(spark):
    assert [T.key_range(4, i) for i in range(4)] == [(0, 16383), (16384, 32767), (32768, 49151), (49152, 65535)]
    with pytest.raises(ValueError):
        T.key_range(4, 4)


def test_key_ranges_split_messages_once(log):
    counts = [T.key_range_scan(log, 5, i).count() for i in range(5)]
    assert sum(counts) == 27


def test_each_partition_has_one_owner(log):
    owned = T.assign_partitions(T.partitions(log), 2)
    assert owned.count() == 3
    # partitions of a topic follow each other around the readers
    by_partition = dict(rows(owned, "partition", "reader"))
    assert by_partition[0] == by_partition[2] != by_partition[1]
    assert T.assign_partitions(T.partitions(log), 2, key_ranges=True).count() == 6


def test_sentinels():
    assert SENTINEL_LEDGERS == (-1, 2**63 - 1)


def test_a_stored_log_skips_ledgers(spark, path):
    from topiclake.operators.sinks import write

    where = path("log")
    data = messages(spark, [(p, e, "k", str(e), e) for p in range(4) for e in range(30)])
    data = data.withColumn("ledger_id", F.expr("entry_id DIV 10"))
    write(data, where)
    m = T.read_log(spark, where)
    marks = S.high_water(data.where("partition < 2 AND ledger_id < 2")).unionByName(
        S.high_water(data.where("partition = 2")).withColumn("last", F.lit(None).cast("struct<ledger_id: bigint, entry_id: bigint, batch_index: int>"))
    )
    got = S.with_start(m, "latest", marks=marks)
    assert rows(got, "partition", "entry_id") == rows(S.with_start(data, "latest", marks=marks), "partition", "entry_id")
    assert got.groupBy("partition").count().orderBy("partition").collect() == [(0, 10), (1, 10), (2, 30), (3, 30)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ledger_id,1)" in plan
    assert "partition#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def cursor(spark, *positions):
    rows = [("s", "persistent://public/default/t", 0, *p, i, False, False) for i, p in enumerate(positions)]
    return spark.createDataFrame(rows, K.CURSORS)


def test_a_cursor_inside_an_entry(spark):
    m = messages(spark, [(0, 0, "a", "v", 0)]).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(4))))
    m = m.withColumn("batch_index", F.col("n")).withColumn("entry_id", F.lit(1).cast("bigint")).drop("n")
    rest = S.with_start(m, "external-subscription", cursors=cursor(spark, (0, 1, 1)), subscription="s")
    assert rows(rest, "batch_index") == [(2,), (3,), (4,)]
    assert S.with_start(m, "external-subscription", cursors=cursor(spark, (0, 1, -1)), subscription="s").count() == 0


def test_the_table_of_commits_as_cursors(spark):
    m = messages(spark, [(0, e, "a", "v", e) for e in range(8)])
    rest = S.with_start(m, "external-subscription", cursors=cursor(spark, (0, 1, -1), (0, 2, -1)), subscription="s")
    assert rows(rest, "entry_id") == [(3,), (4,), (5,), (6,), (7,)]


def test_a_start_table_that_names_a_partition_twice(spark):
    m = messages(spark, [(0, e, "a", "v", e) for e in range(6)])
    start = ((0, 3, -1), True)
    starts = spark.createDataFrame([("persistent://public/default/t", 0, *start)] * 2, S.STARTS_DDL)
    assert rows(S.from_starts(m, starts), "entry_id") == [(3,), (4,), (5,)]


def test_marks_of_a_killed_first_start_do_not_count(spark, path):
    m, where = messages(spark, [(0, e, "a", "v", e) for e in range(6)]), path("marks")
    spark.range(0).write.parquet(f"{where}/_unfinished/marks-x")
    assert S.captured_marks(m, where).count() == 1
    assert S.captured_marks(m.limit(0), where).count() == 1


def test_a_java_regex(spark):
    m = messages(spark, [(0, 0, "a", "v", 0)])
    assert T.scan(m, pattern="public/default/\\p{Alpha}").count() == 1
    with pytest.raises(Exception, match="(?i)regex|pattern"):
        T.scan(m, pattern="public/default/(t")
