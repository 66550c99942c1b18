"""Saved read positions: an append-only table, of which the newest row counts."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from topiclake.envelope import LOG

CURSORS = T.StructType(
    [
        T.StructField("subscription", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("ledger_id", T.LongType()),
        T.StructField("entry_id", T.LongType()),
        T.StructField("batch_index", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("external", T.BooleanType()),
        T.StructField("removed", T.BooleanType()),
    ]
)
COMMIT_RETRIES = 3
# Ledger ids of the marks "earliest" and "latest", which are not positions.
SENTINEL_LEDGERS = (-1, 9223372036854775807)


def range_subscription(subscription: str, start: int = 0, end: int = 65535) -> str:
    """Name under which a reader of part of the key-hash ring saves its cursors."""
    return subscription if (start, end) == (0, 65535) else f"{subscription}[{start}, {end}]"


def commit_rows(
    positions: DataFrame, subscription: str, seq: int, *, existing: DataFrame | None = None, external: bool = False
) -> DataFrame:
    """Positions per topic partition as rows of the cursor table.

    Marks that are not positions are skipped, and so are topics that no longer exist
    when ``existing`` partitions are given.
    """
    rows = positions.where(~F.col("ledger_id").isin(*SENTINEL_LEDGERS))
    if existing is not None:
        rows = rows.join(existing.select(*LOG), LOG, "left_semi")
    return rows.select(
        F.lit(subscription).alias("subscription"),
        *LOG,
        "ledger_id",
        "entry_id",
        "batch_index",
        F.lit(seq).cast("bigint").alias("seq"),
        F.lit(external).alias("external"),
        F.lit(False).alias("removed"),
    )


def commit_cursors(rows: DataFrame, path: str, *, retries: int = COMMIT_RETRIES, pause: float = 1.0) -> None:
    """Append a commit; a failed attempt is repeated a few times."""
    for attempt in range(retries + 1):
        try:
            rows.coalesce(1).write.mode("append").parquet(path)
            return
        except Exception:
            if attempt == retries:
                raise
            time.sleep(pause)


def read_cursors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CURSORS).parquet(path)


def current_cursors(cursors: DataFrame) -> DataFrame:
    """The newest position of every subscription and topic partition that was not removed."""
    rest = ["ledger_id", "entry_id", "batch_index", "external", "removed"]
    return (
        cursors.groupBy("subscription", *LOG)
        .agg(F.max_by(F.struct(*rest), "seq").alias("_newest"), F.max("seq").alias("seq"))
        .select("subscription", *LOG, "_newest.*", "seq")
        .where(~F.col("removed"))
    )


def drop_cursor(spark: SparkSession, path: str, subscription: str) -> None:
    """Remove the cursors a read made for itself; those made outside are kept."""
    mine = current_cursors(read_cursors(spark, path)).where(
        (F.col("subscription") == subscription) & ~F.col("external")
    )
    gone = mine.withColumn("removed", F.lit(True)).withColumn("seq", F.col("seq") + 1)
    commit_cursors(gone.select(*CURSORS.names), path)
