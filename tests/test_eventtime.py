from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from topiclake.operators import eventtime as E
from topiclake.operators.cursors import commit_rows


def arrivals(spark, *steps):
    """(batch, partition, time) with whole numbers as times."""
    return spark.createDataFrame([("t", p, b, ts) for b, p, ts in steps], "topic STRING, partition INT, batch INT, ts BIGINT")


def marks(df):
    return [r.watermark for r in df.orderBy("batch").select("watermark").collect()]


def test_watermark_is_the_minimum_of_partitions(spark):
    m = arrivals(spark, (0, 1, 1), (0, 1, 2), (0, 1, 1), (1, 1, 3), (1, 2, 12), (2, 3, 101), (2, 3, 102), (3, 3, 1003), (3, 3, 1005), (4, 1, 30), (5, 2, 13), (6, 2, 15))
    assert marks(E.partition_watermark(m, "batch", "ts")) == [None, None, 3, 3, 12, 13, 15]


def test_punctuated_watermark(spark):
    m = arrivals(spark, (0, 1, 1), (0, 1, 3), (1, 2, 12), (1, 2, 13), (2, 3, 100), (3, 3, 99), (4, 1, 20), (5, 1, 21))
    got = E.partition_watermark(m, "batch", "ts", when=F.col("ts") % 3 == 0)
    assert marks(got) == [None, None, None, 3, 3, 12]


def test_declared_partitions_hold_the_watermark(spark):
    m = arrivals(spark, (0, 1, 5), (1, 1, 6))
    assert marks(E.partition_watermark(m, "batch", "ts")) == [5, 6]
    assert marks(E.partition_watermark(m, "batch", "ts", partitions=2)) == [None, None]


def test_idle_partitions_are_left_out_and_never_turn_time_back(spark):
    m = arrivals(spark, (0, 1, 10), (0, 2, 1), (1, 1, 20), (2, 1, 30), (3, 1, 40), (4, 2, 5), (5, 1, 50))
    assert marks(E.partition_watermark(m, "batch", "ts")) == [1, 1, 1, 1, 5, 5]
    assert marks(E.partition_watermark(m, "batch", "ts", idle_after=2)) == [1, 1, 1, 40, 40, 40]


def test_running_highest_over_chunks(spark):
    values = [3, None, 1, 7, 2, 5, None, 9, 8, 4]
    df = spark.createDataFrame(list(enumerate(values)), "batch BIGINT, watermark BIGINT")
    assert marks(E._never_back(df, 3)) == [3, 3, 3, 7, 7, 7, 7, 9, 9, 9]


def test_delay_and_late_rows(spark):
    data = [("t", 0, b, at(s)) for b, s in ((0, 100), (1, 50), (1, 95), (2, 89), (2, 200))]
    m = spark.createDataFrame(data, "topic STRING, partition INT, batch INT, ts TIMESTAMP")
    on_time, late = E.split_late(m, "batch", "ts", delay_ms=10_000)
    assert rows(late, "batch", F.unix_seconds("ts") - 1704067200) == [(1, 50), (2, 89)]
    assert on_time.count() == 3


def test_tumble_emits_closed_windows(spark):
    data = [(at(s), price) for s, price in ((0, 2.0), (1, 50.0), (3, 1.0), (4, 5.33), (8, 1.5), (10, 7.0), (None, 9.0)) if s is not None]
    df = spark.createDataFrame([*data, (None, 9.0)], "log_ts TIMESTAMP, price DOUBLE").withColumn("ts", F.col("log_ts") + F.expr("INTERVAL 1 SECOND"))
    aggs = [F.count("*").alias("n"), F.max("price").alias("top")]
    closed = E.tumble(df, "ts", "5 seconds", aggs)
    ends = F.unix_seconds("window_end") - 1704067200
    assert rows(closed, ends, "n", "top") == [(5, 3, 50.0), (10, 2, 5.33)]
    # a delay keeps windows open longer; on request open windows come too
    assert E.tumble(df, "ts", "5 seconds", aggs, delay="2 seconds").count() == 1
    assert E.tumble(df, "ts", "5 seconds", aggs, closed_only=False).count() == 3


def test_event_time(spark):
    df = spark.createDataFrame([(1, at(1)), (2, None)], "i INT, event_time TIMESTAMP")
    chosen = E.with_event_time(df, F.when(F.col("i") == 2, F.lit(at(9))))
    assert rows(chosen, "i", "rowtime") == [(1, at(1)), (2, at(9))]
    assert rows(E.with_event_time(df), "i", "rowtime") == [(1, at(1)), (2, None)]


def numbered(spark, numbers):
    return spark.createDataFrame([("t", 0, n) for n in numbers], "topic STRING, partition INT, sequence_id BIGINT")


def test_audit(spark):
    row = E.audit(numbered(spark, [1, 2, 2, 5, 6, 9, 9, 9])).first()
    assert (row.messages, row.distinct_numbers, row.lowest, row.highest) == (8, 5, 1, 9)
    assert (row.gaps, row.duplicates, row.missing) == (2, 3, 4)
    assert rows(E.gap_ranges(numbered(spark, [1, 2, 2, 5, 6, 9])), "gap_from", "gap_to") == [(3, 4), (7, 8)]
    clean = E.audit(numbered(spark, range(100))).first()
    assert (clean.gaps, clean.duplicates, clean.missing) == (0, 0, 0)


def test_audit_takes_a_row_for_64_numbers(spark):
    dense = E._chunks(numbered(spark, [*range(6_400), *range(6_400)]), "sequence_id")
    assert dense.where("seen IS NOT NULL").count() == 100 and dense.count() == 101


def test_audit_of_any_numbers(spark):
    chance = random.Random(7)
    near = [-(2**62), -129, -128, -65, -64, -63, -1, 0, 1, 62, 63, 64, 65, 127, 128, 129, 191, 192, 256, 2**62, 2**62 + 63]
    for turn in range(6):
        numbers = [chance.choice(near) if turn < 3 else chance.randrange(-300, 300 * turn) for _ in range(12 * (turn + 1) ** 2)]
        there = sorted(set(numbers))
        gaps = [(a + 1, b - 1) for a, b in zip(there, there[1:], strict=False) if b - a > 1]
        row = E.audit(numbered(spark, [*numbers, None, None])).drop("missing").first()
        assert (row.messages, row.distinct_numbers, row.lowest, row.highest) == (len(numbers) + 2, len(there) + 1, there[0], there[-1])
        assert row.gaps == len(gaps)
        assert rows(E.gap_ranges(numbered(spark, [*numbers, None])), "gap_from", "gap_to") == gaps
    row = E.audit(numbered(spark, [None, None])).first()
    assert (row.messages, row.distinct_numbers, row.lowest, row.gaps, row.missing) == (2, 1, None, -1, None)


def test_gaps_of_a_hot_partition(spark, hot):
    numbers = [n for n in range(400) if n % 7]
    assert rows(E.gap_ranges(numbered(spark, numbers)), "gap_from", "gap_to") == [(n, n) for n in range(7, 399, 7)]


def test_sentinels_are_not_committed(spark):
    positions = spark.createDataFrame(
        [("t", 0, 5, 1, -1), ("t", 1, -1, -1, -1), ("t", 2, 2**63 - 1, 0, -1)],
        "topic STRING, partition INT, ledger_id BIGINT, entry_id BIGINT, batch_index INT",
    )
    assert rows(commit_rows(positions, "s", 1), "partition") == [(0,)]
    existing = spark.createDataFrame([("other", 0)], "topic STRING, partition INT")
    assert commit_rows(positions, "s", 1, existing=existing).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_watermarks_of_many_partitions(spark, seed):
    """Against the highest times of all partitions, batch by batch."""
    rng = random.Random(seed)
    steps = [(rng.randint(0, 40), rng.randint(0, 6), rng.choice([None, rng.randint(0, 100)])) for _ in range(rng.choice([20, 150]))]
    m = arrivals(spark, *steps)
    logs, high, want = {p for _, p, _ in steps}, {}, {}
    for b in range(min(s[0] for s in steps), max(s[0] for s in steps) + 1):
        for _, p, ts in (s for s in steps if s[0] == b and s[2] is not None):
            high[p] = max(high.get(p, ts), ts)
        if high:
            want[b] = min(high.values()) - 2 if len(high) == len(logs) else None
    got = {r.batch: r.watermark for r in E.partition_watermark(m, "batch", "ts", delay_ms=2).collect()}
    assert got == want


def test_watermarks_are_not_spread_over_batches_and_partitions(spark):
    """Two hundred partitions that change once, thousands of batches: no row for each of both."""
    m = spark.range(200).selectExpr("'t' AS topic", "CAST(id AS INT) AS partition", "id AS batch", "id AS ts")
    last = spark.createDataFrame([("t", 0, 5000, 9000)], "topic string, partition int, batch bigint, ts bigint")
    marks = E.partition_watermark(m.unionByName(last), "batch", "ts")
    assert marks.count() == 5001 and marks.where("watermark IS NULL").count() == 199
    plan = marks._jdf.queryExecution().executedPlan().toString()
    spread = [line for line in plan.splitlines() if "Generate explode(sequence" in line]
    assert spread and all("explode(sequence(first" in line for line in spread)
