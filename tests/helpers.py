from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from topiclake.envelope import as_envelope

EPOCH = dt.datetime(2024, 1, 1)


def at(seconds: float) -> dt.datetime:
    return EPOCH + dt.timedelta(seconds=seconds)


def messages(spark, rows, topic="persistent://public/default/t"):
    """Envelopes of (partition, entry, key, value, seconds); ledger 0."""
    df = spark.createDataFrame(
        [(p, e, k, v, at(s)) for p, e, k, v, s in rows], "p INT, e BIGINT, k STRING, v STRING, t TIMESTAMP"
    )
    return as_envelope(
        df, topic=topic, partition=F.col("p"), entry_id=F.col("e"), key=F.col("k"), value=F.col("v"),
        publish_time=F.col("t"), event_time=F.col("t"),
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is not None, x) for x in r))
