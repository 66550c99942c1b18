"""The corpus pipeline: five stages over ``documents``, each written and read again.

quality_rules         documents that the rules or the model reject go
line_dedup            lines that are similar to an earlier line go from their text
near_copies           one document of each group of near-copies stays: that with the smallest doc_id
decontaminate         words that a benchmark window covers go from their text
packing               the texts become pieces of training sequences (another table)

All stages but the last return the columns of documents.  A row with NULL text is empty for the
stages and fails the quality rules.  Empty tables pass through as empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from topiclake.llm import decontaminate, lines, near_copies, packing, quality
from topiclake.llm.tables import table
from topiclake.plans.workspace import new_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(docs)


def near_copy_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_copies", near_copy_groups),
    ("decontaminate", benchmark),
    ("packing", pack),
]

#: SQL expresses neither the trained model nor the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
