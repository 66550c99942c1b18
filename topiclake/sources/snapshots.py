"""The last message of every key of a stored log, from a compacted snapshot and the commits since.

A snapshot holds the last message of each key, deletes too, of the commits that it covers, and the names of these.
What it covers is told by commits, not by positions, so a commit that brings low positions late is not
missed.  Reading the current messages reads the newest snapshot and the commits after it and nothing else; ``refresh`` writes the
result as the next snapshot.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from topiclake.envelope import ENVELOPE, KEY_ORDER
from topiclake.operators.changelog import last_of
from topiclake.plans import commits
from topiclake.sources.manifest import commit_log, commit_names

FOLDER = "_compacted"


def _newest(spark: SparkSession, path: str) -> tuple[DataFrame | None, set[str]]:
    """The messages of the newest snapshot and the commits that it covers."""
    number = commits.last_ledger(spark, f"{path}/{FOLDER}")
    if not number:
        return None, set()
    place = f"{path}/{FOLDER}/commit={commits.NUMBERED}{number}"
    covered = {r["commit"] for r in spark.read.schema("commit STRING").parquet(f"{place}/commits").collect()}
    return spark.read.schema(ENVELOPE).parquet(f"{place}/messages"), covered


def _last(spark: SparkSession, path: str) -> tuple[DataFrame, set[str], set[str]]:
    snapshot, covered = _newest(spark, path)
    there = commit_names(spark, path)
    fresh = sorted(there - covered)
    parts = [] if snapshot is None else [snapshot]
    if fresh:
        parts.append(commit_log(spark, path, fresh).select(*ENVELOPE.names))
    if not parts:
        return spark.createDataFrame([], ENVELOPE), covered, there
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if not fresh:  # one message of a key already
        return rows, covered, there
    return last_of(rows.where(F.col("key").isNotNull()), ["topic", "key"], KEY_ORDER).select(*ENVELOPE.names), covered, there


def last_messages(spark: SparkSession, path: str) -> DataFrame:
    """The last message of each topic and key of the log at ``path``; that of a deleted key has no value.

    ``latest_table`` and ``compact`` give of these what they give of the whole log.  Messages without a key are left out.
    """
    return _last(spark, path.rstrip("/"))[0]


def refresh(spark: SparkSession, path: str) -> bool:
    """Write a snapshot of all commits that are there; False if the newest one covers them.

    Snapshots are numbered as they become visible; the older ones stay for readers that have begun.
    """
    path = path.rstrip("/")
    rows, covered, there = _last(spark, path)
    if there <= covered:
        return False

    def put(place: str) -> None:
        rows.write.parquet(f"{place}/messages")
        names = spark.createDataFrame([(n,) for n in sorted(there | covered)], "commit STRING")
        names.coalesce(1).write.parquet(f"{place}/commits")

    return commits.commit_once(spark, f"{path}/{FOLDER}", uuid.uuid4().hex, put, floor=lambda: 0)
