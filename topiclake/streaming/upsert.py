"""The changelog of a keyed topic, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from topiclake.envelope import KEY_ORDER
from topiclake.operators.changelog import normalize
from topiclake.streaming.sinks import start
from topiclake.streaming.state import BUCKETS, KeyedState


def normalize_stream(
    changes: DataFrame,
    pk: list[str],
    state_path: str,
    checkpoint: str,
    emit: Callable[[DataFrame, int], None],
    *,
    order: list[str] | None = None,
    columns: list[str] | None = None,
    buckets: int = BUCKETS,
    available_now: bool = True,
) -> StreamingQuery:
    """``normalize`` over a stream of upserts and deletes.

    The last row of every key is kept between batches, in ``buckets`` by the hash of the key.  A batch reads the buckets of
    its own keys, puts their kept rows before its messages and drops the changes they cause.
    """
    order = KEY_ORDER if order is None else order
    if columns is None:
        columns = [c for c in changes.columns if c not in {"row_kind", *pk, *order}]
    fields = ["row_kind", *pk, *columns, *order]

    def newest(rows: DataFrame) -> DataFrame:
        rest = [c for c in fields if c not in pk]
        return rows.groupBy(*pk).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")).select(*pk, "_last.*")

    state = KeyedState(state_path, pk, newest, buckets=buckets)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # read several times below; lost blocks are read from the source again
        rows = batch.select(*fields).persist()
        try:
            kept = state.before(batch.sparkSession, rows.schema, batch_id, state.touched(rows))
            if kept is None:
                emit(normalize(rows, pk, order, columns), batch_id)
            else:
                seeds = kept.select(*fields).join(rows.select(*pk).distinct(), pk, "left_semi")
                both = seeds.withColumn("_seed", F.lit(0)).unionByName(rows.withColumn("_seed", F.lit(1)))
                changed = normalize(both, pk, ["_seed", *order], columns)
                emit(changed.where("_seed = 1").drop("_seed"), batch_id)
            state.put(newest(rows).select(*fields), batch_id)
        finally:
            rows.unpersist()

    return start(changes, each_batch, checkpoint, available_now=available_now)
