from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from helpers import messages, rows
from topiclake.envelope import LOG, POSITION
from topiclake.operators import eventtime as E, sinks as W
from topiclake.plans import commits
from topiclake.sources import manifest as M, starts as S
from topiclake.sources.topics import read_log, stream_log
from topiclake.streaming import sinks as St


def numbers(spark, low, high, partitions=2):
    return messages(spark, [(i % partitions, i, f"k{i % 5}", f'{{"v": {i}}}', i) for i in range(low, high)])


def files_read(df):
    """Files that the scans of an executed plan have read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName().startswith("Adaptive"):
        plan = plan.finalPhysicalPlan()
    leaves = plan.collectLeaves()
    nodes = [leaves.apply(i) for i in range(leaves.size())]
    return sum(n.metrics().apply("numFiles").value() for n in nodes if n.nodeName().startswith("Scan parquet"))


def test_many_ledgers_take_no_more_rows(spark, path):
    where = path("log")
    m = messages(spark, [(i % 2, i, "k", "v", i) for i in range(300)]).withColumn("ledger_id", F.when(F.col("entry_id") % 50 > 0, F.col("entry_id")))
    W.write(m, where, commit="0", parallelism=2)
    spans = M.files(spark, where).groupBy("partition").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("messages").alias("n"))
    # messages without a ledger come first, as in any order of positions
    assert [(r.partition, r.low.ledger_id, r.low.entry_id, r.high.ledger_id, r.high.entry_id, r.n) for r in spans.orderBy("partition").collect()] == [
        (0, None, 0, 298, 298, 150), (1, 1, 1, 299, 299, 150)
    ]
    plan = M.summarized(read_log(spark, where).select(*LOG, *POSITION, "publish_time", F.lit("f").alias("file_path")), F.col("file_path"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan


def test_files_say_what_the_log_holds(spark, path):
    where = path("log")
    W.write(numbers(spark, 0, 40), where, commit="0")
    W.write(numbers(spark, 40, 60, partitions=3), where, new_ledger=True)
    numbers(spark, 60, 70).coalesce(1).write.partitionBy(*LOG).parquet(f"{where}/commit=by hand")  # without positions of its own
    found = M.files(spark, where)
    assert found.count() == 7
    m = read_log(spark, where)
    assert rows(M.positions(found), *LOG, "ledger_id", "entry_id", "batch_index") == rows(E.positions(m), *LOG, "ledger_id", "entry_id", "batch_index")
    sums = found.agg(F.sum("messages"), F.min("earliest"), F.max("latest")).first()
    assert tuple(sums) == tuple(m.agg(F.count("*"), F.min("publish_time"), F.max("publish_time")).first())
    assert M.files(spark, path("nothing")).count() == 0


def test_positions_are_found_without_messages(spark, path):
    where = path("log")
    W.write(numbers(spark, 0, 40), where)
    assert all(f"/{M.FOLDER}/" in f for f in M.positions(M.files(spark, where)).inputFiles())


@pytest.mark.parametrize("at", [-1, 0, 17, 39, 40, 59, 99])
def test_backlog_reads_only_files_that_a_cursor_cuts(spark, path, at):
    where = path("log")
    for i in range(3):
        W.write(numbers(spark, i * 20, i * 20 + 20, partitions=3), where, commit=f"{i}")
    cursors = spark.createDataFrame([("persistent://public/default/t", p, 0, at, -1) for p in (0, 1)], "topic string, partition int, ledger_id long, entry_id long, batch_index int")
    want = rows(E.backlog(read_log(spark, where), cursors), "partition", "backlog", "messages")
    assert rows(M.backlog(spark, where, M.files(spark, where), cursors), "partition", "backlog", "messages") == want


def test_one_of_many_partitions_lags(spark, path):
    where, n, late = path("log"), 1200, 40
    early = spark.range(n).select(F.col("id").cast("int").alias("p"))
    for i, (part, entry) in enumerate(((early, 0), (early.where(f"p < {late}"), 1))):
        W.write(_spread(part, entry), where, commit=f"{i}")
    starts = early.select(F.lit("persistent://public/default/t").alias("topic"), F.col("p").alias("partition"), F.when(F.col("p") != 1111, F.expr("struct(0L AS ledger_id, 0L AS entry_id, -1 AS batch_index)")).alias("start"), F.lit(False).alias("inclusive"))
    rest = S.from_starts(read_log(spark, where), starts)
    assert files_read(rest) == late + 1
    assert rows(rest, "partition", "entry_id") == sorted([(1111, 0), *[(p, 1) for p in range(late)]])


def _spread(part, entry):
    m = W.to_messages(part, topic="t", value=F.lit(b"x"), sequence=F.lit(entry), key=F.col("p").cast("string").cast("binary"))
    return m.withColumn("partition", F.col("key").cast("string").cast("int"))


def test_only_stored_logs_are_pruned(spark, path):
    where, other = path("log"), path("other")
    for place in (where, other):
        for i in range(2):
            W.write(numbers(spark, i * 10, i * 10 + 10), place, commit=f"{i}")
    stored = read_log(spark, where)
    starts = S.latest_starts(S.high_water(stored.where("entry_id < 10")))
    want = [(i,) for i in range(10, 20)]
    assert files_read(S.from_starts(stored, starts)) == 2 and rows(S.from_starts(stored, starts), "entry_id") == want
    both = stored.unionByName(read_log(spark, other))
    assert rows(S.from_starts(both, starts), "entry_id") == sorted(want * 2)
    # what was changed is no longer what the files hold
    moved = stored.withColumn("partition", 1 - F.col("partition"))
    assert M.log_path(stored) == where and M.log_path(moved) is None
    assert files_read(S.from_starts(moved, starts)) == 4


def test_streams_read_on_in_later_files(spark, path):
    where, out, checkpoint = path("log"), path("out"), path("checkpoint")
    for i in range(3):
        W.write(numbers(spark, i * 10, i * 10 + 10), where, commit=f"{i}")
    starts = S.latest_starts(S.high_water(read_log(spark, where).where("entry_id < 20")))
    for i in range(3, 5):
        St.write_stream(S.from_starts(stream_log(spark, where), starts), out, checkpoint, "exactly-once").awaitTermination()
        W.write(numbers(spark, i * 10, i * 10 + 10, partitions=3), where, commit=f"{i}")
    St.write_stream(S.from_starts(stream_log(spark, where), starts), out, checkpoint, "exactly-once").awaitTermination()
    assert rows(read_log(spark, out), "entry_id") == [(i,) for i in range(20, 50)]


def _put(spark, n):
    return lambda place: spark.range(n).write.parquet(place)


def test_numbers_rise_without_holes_whoever_writes(spark, path):
    where, done = path("log"), []

    def one(i):
        done.append((i, commits.commit_once(spark, where, f"w{i % 6}", _put(spark, 3), floor=lambda: 100)))

    threads = [threading.Thread(target=one, args=(i,)) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    # of two writers of a name one succeeds
    assert sorted(i % 6 for i, ok in done if ok) == list(range(6))
    assert commits.last_ledger(spark, where) == 106
    assert all(commits.exists(spark, f"{where}/commit=ledger-{n}") for n in range(101, 107))
    assert not commits.commit_once(spark, where, "w0", _put(spark, 3), floor=lambda: 100)


@pytest.mark.parametrize("numbered", [True, False])
@pytest.mark.parametrize("step", [0, 1])
def test_killed_at_any_step(spark, path, monkeypatch, numbered, step):
    """Before the name is claimed, and between the claim and the publication."""
    where, real, left, asked = path("log"), commits.moved, [step], []

    def dies(*args):
        if left[0] == 0:
            left[0] = -1
            raise OSError("killed")
        left[0] -= 1
        return real(*args)

    monkeypatch.setattr(commits, "moved", dies)
    more = {"floor": (lambda: 0) if numbered else None, "before": asked.append}
    with pytest.raises(OSError):
        commits.commit_once(spark, where, "a", _put(spark, 3), **more)
    commits.commit_once(spark, where, "a", _put(spark, 3), **more)
    assert not commits.commit_once(spark, where, "a", _put(spark, 3), **more)
    assert spark.read.parquet(where).count() == 3
    assert asked  # what belongs to the commit is made before it is seen, again after a kill


def test_a_move_never_replaces_or_enters(spark, path):
    a, b = path("a"), path("b")
    for place in (a, b):
        spark.range(1).write.parquet(place)
    assert not commits.moved(spark, a, b) and not commits.moved(spark, path("none"), path("new"))
    assert commits.exists(spark, a) and not commits.exists(spark, f"{b}/{a.rpartition('/')[2]}")
    assert commits.recorded(spark, f"{path('r')}/x") is None
    place = f"{path('r')}/x"
    assert commits.recorded(spark, place, "1") == commits.recorded(spark, place, "2") == commits.recorded(spark, place) == "1"


def test_own_ledgers_come_before_numbered_ones(spark, path):
    where = path("log")
    W.write(numbers(spark, 0, 4).withColumn("ledger_id", F.lit(7).cast("long")), where)
    for _ in range(2):
        W.write(numbers(spark, 0, 4), where, new_ledger=True)
    assert rows(read_log(spark, where).select("ledger_id").distinct(), "ledger_id") == [(7,), (8,), (9,)]
