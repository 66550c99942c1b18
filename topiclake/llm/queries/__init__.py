"""One query per operator over the given tables.

``QUERIES`` maps a name to a function (spark, folder of the tables) -> DataFrame, ``ORACLES`` to SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


from topiclake.llm.queries import conversations, documents, embeddings, pages  # noqa: E402, F401
