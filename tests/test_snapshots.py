from __future__ import annotations

from pyspark.sql import functions as F

from helpers import messages, rows
from topiclake.operators import sinks as W
from topiclake.operators.changelog import compact, latest_table
from topiclake.sources import snapshots
from topiclake.sources.topics import read_log


def part(spark, low, high):
    return messages(spark, [(i % 2, i, None if i % 11 == 0 else f"k{i * 7 % 13}", None if i % 5 == 0 else f'{{"v": {i}}}', i) for i in range(low, high)])


def test_current_messages_are_those_of_the_whole_log(spark, path):
    where = path("log")
    assert snapshots.last_messages(spark, where).count() == 0 and not snapshots.refresh(spark, where)
    pk = {"id": F.col("key").cast("string")}
    columns = ["partition", "entry_id", F.col("key").cast("string").alias("k"), F.col("value").cast("string").alias("v")]
    for i in range(4):
        # commits come in no order of their positions
        W.write(part(spark, (i * 7 % 4) * 15, (i * 7 % 4) * 15 + 15), where, commit=f"{i}")
        now, log = snapshots.last_messages(spark, where), read_log(spark, where)
        assert rows(compact(now), *columns) == rows(compact(log), *columns)
        assert rows(latest_table(now, pk, "v INT"), "id", "v") == rows(latest_table(log, pk, "v INT"), "id", "v")
        if i in (0, 2):
            assert snapshots.refresh(spark, where) and not snapshots.refresh(spark, where)
            # a snapshot is read as it is: nothing is aggregated, nothing of the log is read
            again = snapshots.last_messages(spark, where)
            assert all("/_compacted/" in f for f in again.inputFiles())
            assert "Aggregate" not in again._jdf.queryExecution().executedPlan().toString()
    # the snapshot of three commits, and the fourth
    names = snapshots.last_messages(spark, where).inputFiles()
    assert all("/_compacted/commit=ledger-2/" in f or "/commit=3/" in f for f in names)


def test_snapshots_of_numbered_commits(spark, path):
    where = path("log")
    for i in range(3):
        W.write(messages(spark, [(0, 5 - i, "a", f"{i}", i)]), where, new_ledger=True)
        if i == 1:
            snapshots.refresh(spark, where)
    assert rows(snapshots.last_messages(spark, where).select("ledger_id", F.col("value").cast("string").alias("v")), "ledger_id", "v") == [(3, "2")]
