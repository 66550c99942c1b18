"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
import check
from topiclake import checks

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(checks.QUERIES)
HOT = ["changelog_normalize", "temporal_left_join", "temporal_inner_join", "version_intervals", "delivery_gaps"]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def compare(spark, db, name):
    df = entry_module.queries()[name](spark, FOLDER)
    cursor = db.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(df.columns) == sorted(columns)
    assert {f.name: check.spark_kind(f.dataType.simpleString()) for f in df.schema.fields} == kinds
    assert check.rows_of(df.columns, [tuple(r) for r in df.collect()]) == check.rows_of(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(checks.ORACLES) == set(NAMES)
    assert set(NAMES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    compare(spark, db, name)


@pytest.mark.parametrize("name", HOT)
def test_query_with_hot_keys(spark, db, hot, name):
    compare(spark, db, name)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_the_stream_of_windows_reads_tombstones(spark, db, monkeypatch):
    from topiclake.checks import sinks

    seen, stored = [], sinks.stored_in_parts
    monkeypatch.setattr(sinks, "stored_in_parts", lambda spark, m, *more: seen.append(m) or stored(spark, m, *more))
    compare(spark, db, "stream_tumble_agg")
    assert seen[0].where("value IS NULL").count() > 0


def test_counts_of_counts_are_retracted(spark, db, monkeypatch):
    from topiclake.operators import changelog

    seen, count_change = [], changelog.count_change
    monkeypatch.setattr(changelog, "count_change", lambda changes, by: seen.append(changes) or count_change(changes, by))
    compare(spark, db, "count_of_counts_having")
    kinds = {r.row_kind: r["count"] for r in seen[0].groupBy("row_kind").count().collect()}
    assert kinds["-U"] == kinds["+U"] > 0 and kinds["+I"] > 0
