from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from helpers import at, messages, rows
from topiclake.operators import sinks as W
from topiclake.operators.changelog import decode_upsert, normalize
from topiclake.sources.topics import read_log, stream_log
from topiclake.streaming.state import KeyedState
from topiclake.streaming.upsert import normalize_stream
from topiclake.streaming.watermarks import tumble_stream


def newest(df):
    return df.groupBy("k").agg(F.max("v").alias("v"))


@pytest.mark.parametrize("every", [1, 2, 3, 20])
def test_keyed_state_merges_and_batches_run_again(spark, path, every):
    state = KeyedState(path("state"), ["k"], newest, every, buckets=4)
    schema = "k STRING, v INT"

    def put(n):
        state.put(spark.createDataFrame([("a", n), (f"k{n}", n)], schema), n)

    def seen(n, buckets=None):
        before = state.before(spark, schema, n, buckets)
        return {} if before is None else dict(rows(before, "k", "v"))

    for n in range(8):
        want = {**({"a": n - 1} if n else {}), **{f"k{i}": i for i in range(n)}}
        assert seen(n) == want
        some = state.touched(spark.createDataFrame([("a",)], "k STRING"))
        assert len(some) == 1 and seen(n, some).get("a") == want.get("a") and set(seen(n, some)) <= set(want)
        put(n)
        # the batch runs again: it sees the same and changes nothing
        assert seen(n) == want
        put(n)
    # every bucket has a base that counts, and at most one that a batch running again may need
    bases = {}
    for folder, _, files in os.walk(state.path):
        if "base=" in folder and any(f.endswith(".parquet") for f in files):
            bases.setdefault(folder.rpartition("_bucket=")[2], []).append(folder)
    assert all(len(b) <= 2 for b in bases.values())


def test_a_batch_of_few_keys_reads_few_files(spark, path):
    state = KeyedState(path("state"), ["k"], newest, 4, buckets=64)
    schema = "k BIGINT, v BIGINT"
    for n in range(6):
        state.put(spark.range(5000).selectExpr("id AS k", f"id + {n} AS v"), n)
    few = spark.createDataFrame([(17, 0), (18, 0)], schema)
    read = state.before(spark, schema, 6, state.touched(few))
    files = {f.rpartition("_bucket=")[2].partition("/")[0] for f in read.inputFiles()}
    assert len(files) <= 2 and len(read.inputFiles()) <= 2 * 3  # of each bucket its base and two batches
    assert dict(rows(read.where("k IN (17, 18)"), "k", "v")) == {17: 22, 18: 23}
    # the number of buckets is the state's own
    assert KeyedState(state.path, ["k"], newest, buckets=9).buckets(spark) == 64


def changes(m):
    return decode_upsert(m, {"id": F.col("key").cast("string")}, "v INT")


def test_normalized_stream_of_many_micro_batches(spark, path):
    def part(low, high):
        return messages(spark, [(0, i, f"k{i * 7 % 23}", None if i % 6 == 5 else f'{{"v": {i % 4}}}', i) for i in range(low, high)])

    source, out = path("log"), path("changes")
    for i in range(5):
        W.write(part(i * 5, i * 5 + 5), source, commit=f"{i:02}")
    normalize_stream(
        changes(stream_log(spark, source, 1)), ["id"], path("state"), path("checkpoint"),
        lambda df, n: df.write.mode("overwrite").parquet(f"{out}/part={n}"), columns=["v"], buckets=5,
    ).awaitTermination()
    columns = ["row_kind", "id", "v", "entry_id", "step"]
    assert rows(spark.read.parquet(out), *columns) == rows(normalize(changes(read_log(spark, source)), ["id"], columns=["v"]), *columns)


def windows(spark, path, parts, **more):
    """Hourly counts of a stream of (partition, seconds); the micro-batch in which each window came."""
    source, state, got = path("log"), path("state"), {}
    for i, part in enumerate(parts):  # a file for each micro-batch
        m = messages(spark, [(p, i * 1000 + n, "k", f"{n}", s) for n, (p, s) in enumerate(part)])
        m = m.select("topic", "partition", "event_time", "entry_id").coalesce(1)
        m.write.parquet(f"{source}/part={i:02}")

    def emit(df, batch_id):
        for r in df.collect():
            hour = round((r.window_start - at(0)).total_seconds()) // 3600
            assert hour not in got and (r.window_end - r.window_start).total_seconds() == 3600
            got[hour] = (batch_id, r.n, r.top)

    aggs = [F.count("*").alias("n"), F.max("entry_id").alias("top")]
    stream = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(source).select(*m.columns)
    clock = iter(range(0, 1000 * 1_000_000, 1_000_000))
    tumble_stream(stream, "event_time", "1 hour", aggs, emit, state, path("checkpoint"), clock=lambda: next(clock), **more).awaitTermination()
    left = [d for d in os.listdir(f"{state}/windows") if d.startswith("_end=")] if os.path.exists(f"{state}/windows") else []
    return got, left


H = 3600
ONE = [[(0, 10), (1, 20), (0, H + 5)], [(1, H + 1), (1, 3), (0, 2 * H + 1)], [(1, 2 * H + 2), (0, 30)], [(0, 5 * H), (1, 5 * H)], [(0, 6 * H)]]


@pytest.mark.parametrize("merged", [False, True])
def test_windows_close_once_and_are_removed(spark, path, merged):
    merge = [F.sum("n").alias("n"), F.max("top").alias("top")] if merged else None
    got, left = windows(spark, path, ONE, merge=merge)
    # a row of the first hour that comes with the third micro-batch is late
    assert got == {0: (1, 3, 1001), 1: (2, 2, 1000), 2: (3, 2, 2000)}
    assert len(left) == 2  # the hours that are open


def test_silent_partitions_are_left_out_and_come_back(spark, path):
    parts = [[(0, 10), (1, 20)], [(0, H + 5)], [(0, 2 * H + 1)], [(0, 3 * H + 1)], [(1, H + 50), (0, 4 * H + 1)], [(0, 5 * H + 1)], [(1, 5 * H), (0, 5 * H + 2)]]
    got, _ = windows(spark, path, parts)
    assert got == {0: (4, 2, 1), 1: (6, 2, 4000), 2: (6, 1, 2000), 3: (6, 1, 3000), 4: (6, 1, 4001)}
    got, _ = windows(spark, path, parts, idle_after=2_000_000)
    # from the fourth micro-batch on partition 1 has been silent for more than two seconds of the clock; what it brings then is late
    assert got == {0: (3, 2, 1), 1: (3, 1, 1000), 2: (3, 1, 2000), 3: (6, 1, 3000), 4: (6, 1, 4001)}


def test_a_partition_that_never_came_can_be_given_up(spark, path):
    wanted = spark.createDataFrame([("persistent://public/default/t", p) for p in range(3)], "topic string, partition int")
    got, _ = windows(spark, path, ONE, expected=wanted)
    assert got == {}
    got, _ = windows(spark, path, ONE, expected=wanted, idle_after=2_500_000)
    assert got[2][0] == 3 and set(got) == {0, 1, 2}
