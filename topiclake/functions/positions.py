"""Message positions: comparison, neighbours and their text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

POSITIONS_DDL = "partition INT, ledger_id BIGINT, entry_id BIGINT"


def _field(pos: Column | str, name: str) -> Column:
    return (F.col(pos) if isinstance(pos, str) else pos).getField(name)


def pos_cmp(a: Column | str, b: Column | str) -> Column:
    """-1, 0 or 1; the batch index only counts when both positions have one."""
    batched = (_field(a, "batch_index") >= 0) & (_field(b, "batch_index") >= 0)
    left, right = (
        F.struct(
            _field(p, "ledger_id").alias("ledger_id"),
            _field(p, "entry_id").alias("entry_id"),
            F.when(batched, _field(p, "batch_index")).otherwise(F.lit(-1)).alias("batch_index"),
        )
        for p in (a, b)
    )
    return F.when(left < right, F.lit(-1)).when(left > right, F.lit(1)).otherwise(F.lit(0))


def _make(ledger: Column, entry: Column, batch: Column) -> Column:
    return F.struct(ledger.alias("ledger_id"), entry.alias("entry_id"), batch.cast("int").alias("batch_index"))


def pos_next(pos: Column | str) -> Column:
    """The entry after; a batched position steps to the next entry as a whole."""
    return _make(_field(pos, "ledger_id"), _field(pos, "entry_id") + 1, F.lit(-1))


def pos_prev(pos: Column | str) -> Column:
    """The entry before; inside a batch, the message before in the same entry."""
    batch = _field(pos, "batch_index")
    return _make(
        _field(pos, "ledger_id"),
        F.when(batch >= 0, _field(pos, "entry_id")).otherwise(_field(pos, "entry_id") - 1),
        F.when(batch >= 0, batch - 1).otherwise(F.lit(-1)),
    )


def parse_positions(spark: SparkSession, text: str) -> DataFrame:
    """``ledger:entry:partition;...`` -> rows (partition, ledger_id, entry_id).

    The text is one option value, so it is checked on the driver before any job runs.
    An empty element ends the list and a partition named twice keeps its last position.
    """
    found: dict[int, tuple[int, int, int]] = {}
    for item in text.split(";"):
        if not item:
            break
        parts = item.split(":")
        try:
            if "," in item or len(parts) != 3:
                raise ValueError(item)
            ledger, entry, partition = (int(p) for p in parts)
        except ValueError:
            raise ValueError(
                f"positions are written ledger:entry:partition and separated by semicolons, not {text!r}"
            ) from None
        found[partition] = (partition, ledger, entry)
    if not found:
        raise ValueError(f"no position in '{text}'")
    return spark.createDataFrame(sorted(found.values()), POSITIONS_DDL)


def position_text(pos: Column | str, partition: Column | str) -> Column:
    """Position -> ``ledger:entry:partition``."""
    part = F.col(partition) if isinstance(partition, str) else partition
    return F.concat_ws(":", _field(pos, "ledger_id"), _field(pos, "entry_id"), part)
