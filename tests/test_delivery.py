from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import at, messages, rows
from topiclake.operators import sinks as W
from topiclake.sources.starts import until_marker
from topiclake.sources.topics import read_log, stream_log
from topiclake.streaming import sinks as St
from topiclake.streaming.delivery import deliver_stream, ticking
from topiclake.streaming.markers import stopped, until_marker_stream

START = 1_704_067_200_000_000


def delayed(spark, *parts):
    """Messages of (entry, seconds until due or None)."""
    rows_ = [(i, e, None if s is None else at(s)) for i, part in enumerate(parts) for e, s in part]
    df = spark.createDataFrame(rows_, "part int, e long, due timestamp")
    m = W.to_messages(df, topic="t", value=F.lit(b"x"), sequence=F.col("e"), publish_time=F.lit(at(0)), deliver_at=F.col("due"), partitions=1)
    return [m.where(F.col("entry_id").isin([e for e, _ in part])) for part in parts]


def stored(spark, path, parts):
    where = path("log")
    for i, part in enumerate(parts):
        W.write(part, where, commit=f"{i}")
    return where


def clock(*seconds):
    times = iter(seconds)
    return lambda: START + next(times) * 1_000_000


def collected(out):
    got = {}

    def emit(df, batch_id):
        got[batch_id] = sorted(r.entry_id for r in df.collect())
        if out is not None:
            df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return got, emit


@pytest.mark.parametrize("bucket", [1, 60, 86_400])
def test_nothing_early_nothing_lost(spark, path, bucket):
    parts = delayed(spark, [(1, None), (2, 5), (3, 50), (4, 500)], [(5, 20), (6, 30), (7, None)], [(8, 90), (9, 61)], [(10, 0)])
    got, emit = collected(None)
    source = stored(spark, path, parts)
    deliver_stream(stream_log(spark, source, 1), emit, path("state"), path("checkpoint"), clock=clock(10, 25, 60, 400), bucket=bucket).awaitTermination()
    assert got == {0: [1, 2], 1: [5, 7], 2: [3, 6], 3: [8, 9, 10]}


def test_a_micro_batch_that_runs_again_delivers_the_same(spark, path):
    source = stored(spark, path, delayed(spark, [(1, None), (2, 5), (3, 50)], [(4, 20), (5, 90)], [(6, None)]))
    got, emit = collected(None)
    seen, state, checkpoint = [], path("state"), path("checkpoint")

    def fails(df, batch_id):
        emit(df, batch_id)
        seen.append((batch_id, tuple(got[batch_id])))
        if len(seen) in (1, 3):
            raise RuntimeError("killed")

    for attempt in range(3):
        # the clock has gone on, and goes back once
        query = deliver_stream(stream_log(spark, source, 1), fails, state, checkpoint, clock=clock(*((10, 60, 100), (70, 5, 5), (5, 5, 5))[attempt]))
        if attempt < 2:
            with pytest.raises(Exception, match="killed"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert seen[0] == seen[1] == (0, (1, 2)) and seen[2] == seen[3]
    assert got == {0: [1, 2], 1: [3, 4], 2: [6]}  # a clock that goes back stands still; 5 waits


def test_past_hours_are_removed(spark, path):
    source, state = stored(spark, path, delayed(spark, [(1, 100)], [(2, 8000)], [(3, None)], [(4, None)], [(5, None)])), path("state")
    got, emit = collected(None)
    deliver_stream(stream_log(spark, source, 1), emit, state, path("checkpoint"), clock=clock(0, 200, 9000, 20_000, 20_001)).awaitTermination()
    assert got == {0: [], 1: [1], 2: [2, 3], 3: [4], 4: [5]}
    assert not [d for d in os.listdir(f"{state}/held") if d.startswith("_due=")]


def test_a_clock_delivers_when_nothing_arrives(spark, path):
    source = stored(spark, path, delayed(spark, [(1, None), (2, 1)]))
    got, emit = collected(None)
    late = clock(*([0] * 1 + [2] * 1000))
    query = deliver_stream(ticking(stream_log(spark, source)), emit, path("state"), path("checkpoint"), clock=late, interval="1 second")
    try:
        for _ in range(60):
            if sorted(e for b in dict(got).values() for e in b) == [1, 2]:
                break
            time.sleep(1)
    finally:
        query.stop()
    assert sorted(e for b in got.values() for e in b) == [1, 2]


def marked(spark, low, high):
    return messages(spark, [(i % 3, i, "k", "end" if i in (7, 22, 25, 28) else "v", i) for i in range(low, high)])


def test_streams_stop_at_markers(spark, path):
    source, out, state = stored(spark, path, [marked(spark, 0, 6), marked(spark, 6, 15), marked(spark, 15, 24), marked(spark, 24, 30)]), path("out"), path("state")
    got, emit = collected(out)
    marker = F.col("value") == F.lit(b"end")
    until_marker_stream(stream_log(spark, source, 3), marker, emit, state, path("checkpoint")).awaitTermination()
    m = read_log(spark, source)
    assert rows(spark.read.parquet(out), "entry_id") == rows(until_marker(m, marker), "entry_id")
    assert len(got) == 4 and rows(stopped(spark, state, 4).select("partition", "stop.entry_id"), "partition", "entry_id") == [(1, 7)]
    with pytest.raises(ValueError, match="until_marker_stream"):
        until_marker(stream_log(spark, source), marker)


def test_a_full_disk_sets_nothing_aside(spark, path):
    source, out, bad = stored(spark, path, [marked(spark, 0, 9)]), path("out"), path("bad")

    def broken(part):
        raise OSError("no space left on device")

    with pytest.raises(Exception, match="no space"):
        St.write_stream(stream_log(spark, source), out, path("checkpoint"), source=broken, fail_on_write=False, quarantine_path=bad).awaitTermination()
    assert not os.path.exists(out + "/commit=0") and not os.path.exists(bad)


def test_what_is_an_error_of_a_row(spark):
    def error(column):
        try:
            spark.range(1).select(column).collect()
        except Exception as e:
            return e

    assert St.row_error(error(F.raise_error(F.lit("x")))) and St.row_error(error(F.lit("x").cast("int") + F.col("id"))) and St.row_error(error(F.lit(1) / (F.col("id") * 0)))
    assert St.row_error(error(F.udf(lambda x: 1 // 0)("id")))
    try:
        spark.read.parquet("/nowhere/at/all").collect()
    except Exception as e:
        assert not St.row_error(e)
    assert not St.row_error(OSError("disk"))


def test_marked_messages_are_set_aside_with_their_reason(spark, path):
    source, out, bad = stored(spark, path, [marked(spark, 0, 20)]), path("out"), path("bad")
    calls = []

    def source_of(part):
        calls.append(1)
        return part.withColumn(St.ERROR, F.when(F.col("entry_id") % 5 == 2, F.concat(F.lit("no "), F.col("entry_id"))))

    def run(checkpoint, **more):
        St.write_stream(stream_log(spark, source), out, checkpoint, "exactly-once", source=source_of, quarantine_path=bad, **more).awaitTermination()

    with pytest.raises(Exception, match="cannot be written: no"):
        run(path("checkpoint"))
    calls.clear()
    run(path("checkpoint"), fail_on_write=False)
    assert len(calls) == 1
    assert rows(read_log(spark, out), "entry_id") == [(i,) for i in range(20) if i % 5 != 2]
    assert rows(spark.read.parquet(bad), "entry_id", St.ERROR) == [(i, f"no {i}") for i in (2, 7, 12, 17)]
