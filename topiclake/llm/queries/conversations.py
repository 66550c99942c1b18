"""Queries over ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topiclake.llm import chat
from topiclake.llm.queries import query
from topiclake.llm.tables import table


@query("op6_chat_repair")
def op6_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repair(table(spark, folder, "conversations"))
