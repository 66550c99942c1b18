"""Queries over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from topiclake.llm import whitening
from topiclake.llm.queries import query
from topiclake.llm.tables import table


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.components(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "component", "n", "deviation", F.col("value").alias("whitened"), "explained", "identity_error")
