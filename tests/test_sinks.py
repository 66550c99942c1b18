from __future__ import annotations

import logging
import os

import pytest
from pyspark.sql import functions as F

from helpers import at, messages, rows
from topiclake.operators import cursors as K, eventtime as E, sinks as W
from topiclake.operators.changelog import decode_upsert, latest, normalize
from topiclake.operators.routing import route
from topiclake.operators.temporal import as_of_join
from topiclake.plans.workspace import shared_dir
from topiclake.sources.starts import captured_marks, with_start
from topiclake.sources.topics import partitions, read_log, scan, stream_log
from topiclake.streaming import sinks as St
from topiclake.streaming.state import BatchState, WholeState
from topiclake.streaming.temporal import as_of_join_stream
from topiclake.streaming.upsert import normalize_stream
from topiclake.streaming.watermarks import tumble_stream


def numbers(spark, low, high, partitions=2):
    return messages(spark, [(i % partitions, i, f"k{i % 5}", f'{{"v": {i}}}', i) for i in range(low, high)])


def stored(spark, path, *parts):
    """A log whose parts arrive as one file per partition each, in order."""
    where = path("log")
    for i, part in enumerate(parts):
        W.write(part, where, commit=f"{i}")
    return where


def test_write_and_read_back(spark, path):
    where = path("log")
    m = numbers(spark, 0, 20)
    W.write(m, where)
    W.write(numbers(spark, 20, 30), where)
    back = read_log(spark, where)
    assert back.dtypes == m.dtypes and back.count() == 30
    assert "PartitionFilters: [isnotnull(topic" in _plan(scan(back, topic="t"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_are_in_log_order(spark, path):
    where = path("log")
    W.write(numbers(spark, 0, 200).orderBy(F.rand(3)), where, parallelism=3)
    back = read_log(spark, where).withColumn("file", F.input_file_name())
    files = back.groupBy("file").agg(F.collect_list("entry_id").alias("e")).collect()
    assert all(f.e == sorted(f.e) for f in files) and sum(len(f.e) for f in files) == 200


def test_writers_take_large_ranges_in_pieces(spark, path, hot):
    where, tasks = path("log"), 2
    W.write(numbers(spark, 0, 200).orderBy(F.rand(3)), where, parallelism=tasks)
    back = read_log(spark, where).withColumn("file", F.input_file_name())
    assert rows(back, "entry_id") == [(i,) for i in range(200)]
    files = back.groupBy("file").agg(F.collect_list("entry_id").alias("e"), F.min("partition").alias("p")).collect()
    # the limit of a task is 12 rows; ranges are found by a sample
    assert all(f.e == sorted(f.e) and len(f.e) <= 24 for f in files)
    spans = sorted((f.p, f.e[0], f.e[-1]) for f in files)
    assert all(a[0] < b[0] or a[2] < b[1] for a, b in zip(spans, spans[1:], strict=False))
    # part-00000 and part-00001: no job had more writers
    assert {os.path.basename(f.file)[:10] for f in files} == {"part-00000", "part-00001"}
    assert not [f for f in os.listdir(shared_dir(spark)) if f.startswith("topiclake-ranges")]


def test_sink_takes_one_topic(spark):
    with pytest.raises(ValueError, match="one topic"):
        W.to_messages(spark.range(1), topic="a,b", value=F.lit(b""), sequence=F.col("id"))
    with pytest.raises(ValueError, match="read-only"):
        W.check_writable(["eventTime", "topic"])
    W.check_writable(["properties"])


def test_routing(spark):
    m = numbers(spark, 0, 50)
    homes = route(m, 7, "key-hash").groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert {r.n for r in homes.collect()} == {1}
    for bad in ("", "random"):
        with pytest.raises(ValueError):
            route(m, 2, bad)
    with pytest.raises(ValueError):
        route(m, 0)
    with pytest.raises(Exception, match="needs a message key"):
        route(m.withColumn("key", F.lit(None).cast("binary")), 2, "key-hash").collect()


def test_due(spark):
    m = W.to_messages(
        spark.range(3), topic="t", value=F.lit(b"x"), sequence=F.col("id"), publish_time=F.lit(at(0)),
        deliver_at=F.when(F.col("id") > 0, F.timestamp_seconds(1704067200 + F.col("id") * 10)),
    )
    assert rows(W.due(m, F.lit(at(15))), "entry_id") == [(0,), (1,)]


def fail_once(writer, after_write):
    """A batch writer that dies once, after or before its write."""
    state = {"failed": False}

    def write(batch, batch_id):
        if after_write or state["failed"]:
            writer(batch, batch_id)
        if not state["failed"]:
            state["failed"] = True
            raise RuntimeError("killed")

    return write


def run_twice(stream, writer, checkpoint):
    with pytest.raises(Exception, match="killed"):
        St.start(stream(), writer, checkpoint).awaitTermination()
    St.start(stream(), writer, checkpoint).awaitTermination()


@pytest.mark.parametrize("after_write", [True, False])
def test_exactly_once_survives_a_kill(spark, path, after_write):
    source = stored(spark, path, numbers(spark, 0, 40), numbers(spark, 40, 100))
    out = path("out")
    writer = fail_once(St.batch_writer(out, "exactly-once", writer="w"), after_write)
    run_twice(lambda: stream_log(spark, source, 2), writer, path("checkpoint"))
    audit = E.audit(read_log(spark, out)).agg(F.sum("messages"), F.sum("duplicates"), F.sum("gaps")).first()
    assert (audit[0], audit[1]) == (100, 0)


def test_at_least_once_may_repeat_but_loses_nothing(spark, path):
    source = stored(spark, path, numbers(spark, 0, 40))
    out = path("out")
    writer = fail_once(St.batch_writer(out, "at-least-once"), True)
    run_twice(lambda: stream_log(spark, source), writer, path("checkpoint"))
    audit = E.audit(read_log(spark, out)).agg(F.sum("distinct_numbers"), F.sum("duplicates")).first()
    assert tuple(audit) == (40, 40)


def test_a_batch_that_runs_again_changes_nothing(spark, path):
    out = path("out")
    writer = St.batch_writer(out, "exactly-once", writer="w")
    writer(numbers(spark, 0, 15), 0)
    St.write_stream(stream_log(spark, out), path("copy"), follower := path("checkpoint"), "exactly-once").awaitTermination()
    writer(numbers(spark, 0, 15), 0)
    seen = []
    St.start(stream_log(spark, out), lambda batch, _: seen.append(batch.count()), follower).awaitTermination()
    assert read_log(spark, out).count() == 15 and sum(seen) == 0
    with pytest.raises(ValueError):
        St.batch_writer(out, "exactly-once")


def test_streams_and_batches_share_a_log(spark, path):
    out = path("out")
    one, two = stored(spark, path, numbers(spark, 0, 10)), stored(spark, path, numbers(spark, 10, 17))
    for source in (one, two):
        St.write_stream(stream_log(spark, source), out, path("checkpoint"), "exactly-once").awaitTermination()
    assert W.write(numbers(spark, 17, 20), out, commit="mine") and not W.write(numbers(spark, 17, 20), out, commit="mine")
    assert read_log(spark, out).count() == 20
    # a new checkpoint is a new writer
    St.write_stream(stream_log(spark, one), out, path("checkpoint"), "exactly-once").awaitTermination()
    assert read_log(spark, out).count() == 30


def test_an_unfinished_commit_is_not_seen(spark, path):
    out = path("out")
    W.write(numbers(spark, 0, 5), out)
    with pytest.raises(Exception, match="cannot"):
        W.write(numbers(spark, 5, 9).withColumn("value", F.raise_error(F.lit("cannot")).cast("binary")), out, commit="x")
    assert read_log(spark, out).count() == 5
    assert W.write(numbers(spark, 5, 9), out, commit="x") and read_log(spark, out).count() == 9


def test_new_ledgers_rise(spark, path):
    out = path("out")
    for _ in range(2):
        W.write(numbers(spark, 0, 4), out, new_ledger=True)
    found = read_log(spark, out)
    assert found.select("topic", "partition", *W.POSITION).distinct().count() == 8
    assert found.select("ledger_id").distinct().count() == 2


def test_cursors_stay_after_a_new_checkpoint(spark, path):
    where = path("cursors")
    for last in (70, 90):
        source = stored(spark, path, numbers(spark, 0, last, partitions=1))
        St.write_stream(
            stream_log(spark, source), path("out"), path("checkpoint"), "exactly-once", subscription="s", cursor_path=where
        ).awaitTermination()
    assert rows(K.current_cursors(K.read_cursors(spark, where)), "entry_id") == [(89,)]


def test_no_checkpoint_means_no_guarantee(spark, path, caplog):
    source, out = stored(spark, path, numbers(spark, 0, 10)), path("out")
    with caplog.at_level(logging.WARNING, "topiclake"):
        St.write_stream(stream_log(spark, source), out).awaitTermination()
    assert "becomes none" in caplog.text
    assert read_log(spark, out).count() == 10
    with pytest.raises(ValueError):
        St.batch_writer(out, "twice")


def test_fail_on_write(spark, path, caplog):
    source = stored(spark, path, numbers(spark, 0, 10))

    def broken(batch):
        return batch.withColumn("value", F.raise_error(F.lit("cannot encode")).cast("binary"))

    with pytest.raises(Exception, match="cannot encode"):
        St.write_stream(stream_log(spark, source), path("out"), path("checkpoint"), source=broken).awaitTermination()
    def one_broken(batch):
        fails = F.raise_error(F.lit("cannot encode")).cast("binary")
        return batch.withColumn("value", F.when(F.col("entry_id").isin(3, 8), fails).otherwise(F.col("value")))

    out, bad = path("out"), path("bad")
    St.write_stream(
        stream_log(spark, source), out, path("checkpoint"), source=one_broken, fail_on_write=False, quarantine_path=bad
    ).awaitTermination()
    assert "was not written" in caplog.text
    assert rows(read_log(spark, bad), "entry_id") == [(3,), (8,)]
    assert rows(read_log(spark, out), "entry_id") == [(i,) for i in range(10) if i not in (3, 8)]


def test_a_failing_batch_is_read_once_and_cut_in_quarters(spark, path):
    source, sizes = stored(spark, path, numbers(spark, 0, 64)), []

    def one_broken(part):
        sizes.append((part.count(), len(part.inputFiles()) and all("quarters" in f for f in part.inputFiles())))
        fails = F.raise_error(F.lit("cannot encode")).cast("binary")
        return part.withColumn("value", F.when(F.col("entry_id") == 3, fails).otherwise(F.col("value")))

    out, bad = path("out"), path("bad")
    St.write_stream(
        stream_log(spark, source), out, path("checkpoint"), source=one_broken, fail_on_write=False, quarantine_path=bad
    ).awaitTermination()
    assert rows(read_log(spark, bad), "entry_id") == [(3,)]
    assert rows(read_log(spark, out), "entry_id") == [(i,) for i in range(64) if i != 3]
    # only the first attempt reads the batch, the others what was stored for them
    assert sizes[0][0] == 64 and all(own for _, own in sizes[1:]) and sum(n for n, _ in sizes) < 64 * 4
    assert not [f for f in os.listdir(shared_dir(spark)) if f.startswith("topiclake-quarters")]


def test_cursors(spark, path):
    where, source = path("cursors"), stored(spark, path, numbers(spark, 0, 40), numbers(spark, 40, 60))
    St.write_stream(
        stream_log(spark, source, 2), path("out"), path("checkpoint"), "exactly-once", subscription="s", cursor_path=where
    ).awaitTermination()
    K.commit_cursors(K.commit_rows(E.positions(numbers(spark, 0, 9)), "outside", 0, external=True), where)
    current = K.current_cursors(K.read_cursors(spark, where))
    assert rows(current.where("subscription = 's'"), "partition", "entry_id") == [(0, 58), (1, 59)]
    W.write(numbers(spark, 60, 63), source, commit="2")
    rest = with_start(read_log(spark, source), "external-subscription", cursors=current, subscription="s")
    assert rows(rest, "entry_id") == [(60,), (61,), (62,)]
    for name in ("s", "outside"):
        K.drop_cursor(spark, where, name)
    assert rows(K.current_cursors(K.read_cursors(spark, where)), "subscription", "partition") == [("outside", 0), ("outside", 1)]


def test_commit_is_retried():
    class Rows:
        tries = 0

        def coalesce(self, _):
            Rows.tries += 1
            raise OSError("down")

    with pytest.raises(OSError):
        K.commit_cursors(Rows(), "x", retries=3, pause=0)
    assert Rows.tries == 4
    assert K.range_subscription("s") == "s" and K.range_subscription("s", 0, 99) == "s[0, 99]"


def test_restart_with_other_parallelism_and_more_partitions(spark, path):
    source, out, checkpoint = stored(spark, path, numbers(spark, 0, 40)), path("out"), path("checkpoint")
    St.write_stream(stream_log(spark, source), out, checkpoint, "exactly-once").awaitTermination()
    W.write(numbers(spark, 40, 90, partitions=5), source, commit="1")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        St.write_stream(stream_log(spark, source), out, checkpoint, "exactly-once").awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    back = read_log(spark, out)
    assert rows(back, "entry_id") == [(i,) for i in range(90)]
    assert partitions(back).count() == 5


def test_discovery_can_be_turned_off(spark, path):
    source = stored(spark, path, numbers(spark, 0, 10))
    known = partitions(read_log(spark, source))
    W.write(numbers(spark, 10, 40, partitions=4), source, commit="1")
    out = path("out")
    St.write_stream(stream_log(spark, source, only=known), out, path("checkpoint"), "exactly-once").awaitTermination()
    assert partitions(read_log(spark, out)).count() == 2


def test_stream_from_latest(spark, path):
    source = stored(spark, path, numbers(spark, 0, 10))
    marks_path, out, checkpoint = path("marks"), path("out"), path("checkpoint")

    def run():
        marks = captured_marks(read_log(spark, source), marks_path)
        stream = with_start(stream_log(spark, source), "latest", marks=marks)
        St.write_stream(stream, out, checkpoint, "exactly-once").awaitTermination()

    run()
    W.write(numbers(spark, 10, 14), source, commit="1")
    run()
    # a partition that is found later is read from its first message
    W.write(numbers(spark, 14, 20, partitions=3), source, commit="2")
    run()
    assert rows(read_log(spark, out), "entry_id") == [(i,) for i in range(10, 20)]
    with pytest.raises(ValueError, match="marks"):
        with_start(stream_log(spark, source), "latest")


def keyed(spark, low, high):
    data = [(0, i, f"k{i * 7 % 5}", None if i % 6 == 5 else f'{{"v": {i % 4}}}', i) for i in range(low, high)]
    return messages(spark, data)


def changes(m):
    return decode_upsert(m, {"id": F.col("key").cast("string")}, "v INT")


def test_normalized_stream_equals_batch(spark, path):
    parts = [keyed(spark, 0, 30), keyed(spark, 30, 33), keyed(spark, 33, 90)]
    source, out = stored(spark, path, *parts), path("changes")
    normalize_stream(
        changes(stream_log(spark, source, 1)), ["id"], path("state"), path("checkpoint"),
        lambda df, n: df.write.mode("overwrite").parquet(f"{out}/part={n}"), columns=["v"],
    ).awaitTermination()
    want = normalize(changes(read_log(spark, source)), ["id"], columns=["v"])
    columns = ["row_kind", "id", "v", "entry_id", "step"]
    assert rows(spark.read.parquet(out), *columns) == rows(want, *columns)


@pytest.mark.parametrize("every", [1, 2, 3, 20])
def test_state_merges_and_batches_run_again(spark, path, every):
    state = BatchState(path("state"), lambda df: df.groupBy("k").agg(F.max("v").alias("v")), every)

    def put(n):
        state.put(spark.createDataFrame([("a", n), (f"k{n}", n)], "k STRING, v INT"), n)

    def seen(n):
        before = state.before(spark, n)
        return {} if before is None else dict(rows(before, "k", "v"))

    for n in range(8):
        want = {**({"a": n - 1} if n else {}), **{f"k{i}": i for i in range(n)}}
        assert seen(n) == want
        put(n)
        # the batch runs again: it sees the same and changes nothing
        assert seen(n) == want
        put(n)


def test_whole_state(spark, path):
    state = WholeState(path("state"))
    assert state.before(spark, 0) is None
    for n in range(4):
        for _ in range(2):
            assert n == 0 or state.before(spark, n).first().v == n - 1
            state.put(spark.createDataFrame([(n,)], "v INT"), n)


def test_grouped_count_stream(spark, path):
    words = "to be or not to be that is to say be".split()
    parts = [messages(spark, [(0, i, None, w, i) for i, w in enumerate(words[a:b], a)]) for a, b in ((0, 4), (4, 11))]
    source, out = stored(spark, path, *parts), path("counts")
    counts = stream_log(spark, source, 1).groupBy(F.upper(F.col("value").cast("string")).alias("word")).agg(F.count("*").alias("count"))
    St.write_upsert_stream(
        counts.withColumn("row_kind", F.lit("+U")), out, path("checkpoint"), topic="counts", pk=["word"],
        columns=["word", "count"], sequence=F.col("count"), partitions=2,
    ).awaitTermination()
    back = decode_upsert(read_log(spark, out), {"word": F.get_json_object(F.col("key").cast("string"), "$.word")}, "count BIGINT")
    assert dict(rows(latest(back, ["word"]), "word", "count")) == {w.upper(): words.count(w) for w in words}


def both_sides(spark, low, high):
    """Views at every second, versions of two users at some."""
    data = []
    for i in range(low, high):
        user = "ab"[i % 2]
        data.append(("left", user, at(i), i, None, None))
        if i % 5 == 0:
            data.append(("right", user, at(i), None, f"v{i}", i % 10 == 5 and i % 3 == 0))
    return spark.createDataFrame(data, "side STRING, user STRING, ts TIMESTAMP, view INT, name STRING, gone BOOLEAN")


def test_temporal_stream_equals_batch(spark, path):
    source, out = path("sides"), path("joined")
    schema = both_sides(spark, 0, 1).schema
    # the versions of the second part are written before its views, the third closes the windows
    for n, (low, high) in enumerate(((0, 20), (20, 45), (45, 61))):
        both_sides(spark, low, high).coalesce(1).write.parquet(f"{source}/part={n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).select(*schema.names)
    as_of_join_stream(
        stream, ["user"], "ts", ["view"], ["name", "gone"], path("state"), path("checkpoint"),
        lambda df, n: df.write.mode("overwrite").parquet(f"{out}/part={n}"), deleted="gone",
    ).awaitTermination()
    everything = both_sides(spark, 0, 61)
    left = everything.where("side = 'left'").select("user", "ts", "view")
    right = everything.where("side = 'right'").select("user", F.col("ts").alias("since"), "name", "gone")
    want = rows(as_of_join(left, right, ["user"], "ts", "since", deleted="gone"), "view", "name")
    # the highest version is at 60, so every view up to there is final
    assert rows(spark.read.parquet(out), "view", "name") == want


def test_temporal_stream_keeps_rows_without_time_and_waits_for_versions(spark, path):
    source, out = path("sides"), path("joined")
    schema = both_sides(spark, 0, 1).schema

    def part(n, *data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.parquet(f"{source}/part={n}")

    # no version yet; then one that is older than the first view; the last part moves both sides on
    part(0, ("left", "a", at(5), 1, None, None), ("left", "a", None, 2, None, None))
    part(1, ("right", "a", at(3), None, "v3", False))
    part(2, ("right", "a", at(9), None, "v9", False), ("left", "a", at(8), 3, None, None), ("left", "b", at(9), 4, None, None))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source).select(*schema.names)
    as_of_join_stream(
        stream, ["user"], "ts", ["view"], ["name", "gone"], path("state"), path("checkpoint"),
        lambda df, n: df.write.mode("overwrite").parquet(f"{out}/part={n}"), deleted="gone",
    ).awaitTermination()
    got = spark.read.parquet(out)
    assert rows(got, "view", "name") == [(1, "v3"), (2, None), (3, "v3"), (4, None)]
    assert rows(got.where("part = 0"), "view") == [(2,)]


@pytest.mark.parametrize("delay, expected", [("0 seconds", False), ("30 seconds", False), ("0 seconds", True)])
def test_windows_wait_for_the_slowest_of_many_partitions(spark, path, delay, expected):
    """64 partitions; partition 1 comes a day late, micro-batch after micro-batch."""
    def part(i):
        times = [(p, i * 100 + p, "k", '{"v": 1}', (i - (5 if p == 1 else 0)) * 86400 + 60 * p) for p in range(64)]
        return messages(spark, [t for t in times if t[4] >= 0])

    source, out = stored(spark, path, *[part(i) for i in range(9)]), path("out")
    wanted = messages(spark, [(p, 0, "k", "v", 0) for p in range(65 if expected else 64)]).select("topic", "partition")
    stream = stream_log(spark, source, 64).select("topic", "partition", "event_time")
    tumble_stream(
        stream, "event_time", "1 day", [F.count("*").alias("n")], lambda df, n: df.write.mode("overwrite").parquet(f"{out}/part={n}"),
        path("state"), path("checkpoint"), delay=delay, expected=wanted,
    ).awaitTermination()
    if expected:
        # a partition without rows holds all windows
        assert not any(f for _, _, f in os.walk(out))
        return
    got = rows(spark.read.parquet(out).select(F.unix_seconds("window_start").alias("s"), "n"), "s", "n")
    days = [(s - 1704067200) // 86400 for s, _ in got]
    # partition 1 has reached day 3, a minute after midnight
    assert days == [0, 1, 2] and [n for _, n in got] == [64, 64, 64]


def test_shared_dir(spark):
    assert shared_dir(spark)
