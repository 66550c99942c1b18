"""One query per operator over the given tables, with the SQL that gives the same rows.

``QUERIES`` maps a name to a function (spark, folder of the tables) -> DataFrame and
``ORACLES`` to SQL over the same tables.  Every query runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and its SQL."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def load_all() -> None:
    """Import the modules that register queries."""
    from topiclake.checks import catalog, changelogs, decoding, event_time, functions, rows, scans, sinks  # noqa: F401
