"""Keyed topics as changelogs and as tables.

Row kinds are ``+I`` insert, ``-U`` row before an update, ``+U`` row after it, ``-D``
delete.  A changelog DataFrame has ``row_kind``, the columns of the table and the
columns that order the changes of one key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from topiclake.envelope import ENVELOPE, KEY_ORDER
from topiclake.operators.decode import as_struct, decode
from topiclake.plans.skew import last_before

KINDS = ("+I", "-U", "+U", "-D")


def decode_upsert(
    m: DataFrame,
    pk: Mapping[str, Column],
    schema: str,
    *,
    fmt: str = "json",
    keep: list[str] | None = None,
) -> DataFrame:
    """Messages of a keyed topic -> ``+U`` and ``-D`` rows.

    ``pk`` gives the key columns as expressions over the message.  A message without
    value, or with an empty one, deletes its key: the key columns are set and the other
    columns are NULL.  ``keep`` are envelope columns to carry along, by default those
    that order the changes of a key.
    """
    if not pk:
        raise ValueError("an upsert topic needs a primary key")
    gone = F.col("value").isNull() | (F.length("value") == 0)
    fields = [n for n in as_struct(schema).names if n not in pk]
    decoded = decode(m, schema, fmt, into="_row")
    return decoded.select(
        F.when(gone, "-D").otherwise("+U").alias("row_kind"),
        *[expr.alias(name) for name, expr in pk.items()],
        *[F.col(f"_row.`{n}`").alias(n) for n in fields],
        *(KEY_ORDER if keep is None else keep),
    )


def _deletes(kind: Column) -> Column:
    return kind.isin("-D", "-U")


def _comparable(df: DataFrame, column: str, of: Column) -> Column:
    """A column of a row in a form that can be compared: maps by their sorted keys."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.MapType):
        by_key = F.transform(F.array_sort(F.map_keys(of)), lambda k: F.struct(k.alias("k"), F.element_at(of, k).alias("v")))
        return F.to_json(F.struct(by_key.alias("c")))
    return F.to_json(F.struct(of.alias("c"))) if "map<" in kind.simpleString() else of


def normalize(changes: DataFrame, pk: list[str], order: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Upserts and deletes -> a full changelog.

    In the order of a key: a row for an absent key is ``+I``; a changed row gives ``-U``
    with the old and ``+U`` with the new row; deleting a known key gives ``-D`` with the
    old row.  Rows that change nothing and deletes of unknown keys give nothing.
    What a key holds depends on its last message alone, so one look back is enough.
    """
    order = KEY_ORDER if order is None else order
    if columns is None:
        columns = [c for c in changes.columns if c not in {"row_kind", *pk, *order}]
    # the row travels as one column next to the key and the order
    state = F.struct(_deletes(F.col("row_kind")).alias("gone"), F.struct(*columns).alias("row")).alias("_state")
    seen = last_before(changes.select(*pk, *order, state), pk, order, "_state", "_before")
    row, old = F.col("_state.row"), F.col("_before.row")
    gone = F.col("_state.gone")
    known = F.coalesce(~F.col("_before.gone"), F.lit(False))

    def content_of(side: Column) -> Column:
        return F.struct(*[_comparable(changes, c, side[c]).alias(f"c{i}") for i, c in enumerate(columns)])

    same = content_of(row).eqNullSafe(content_of(old))

    def change(kind: str, step: int, content: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(step).alias("step"), content.alias("row"))

    steps = (
        F.when(gone & known, F.array(change("-D", 0, old)))
        .when(~gone & ~known, F.array(change("+I", 0, row)))
        .when(~gone & known & ~same, F.array(change("-U", 0, old), change("+U", 1, row)))
    )
    return seen.select(*pk, *order, F.explode(steps).alias("_change")).select(
        F.col("_change.kind").alias("row_kind"), *pk, "_change.row.*", *order, F.col("_change.step").alias("step")
    )


def latest(changes: DataFrame, pk: list[str], order: list[str] | None = None) -> DataFrame:
    """Current table of a changelog: the last row of each key, without deleted keys.

    An aggregate, so each task reduces its own rows first and a hot key costs nothing.
    """
    order = KEY_ORDER if order is None else order
    last = last_of(changes, pk, order)
    return last.where(~_deletes(F.col("row_kind"))).select(*[c for c in changes.columns if c != "row_kind"])


def last_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last in ``order``."""
    rest = [c for c in rows.columns if c not in {*keys, *order}]
    if any("map<" in rows.schema[c].dataType.simpleString() for c in rest):
        # maps cannot be compared, so they cannot stand in the struct that is
        newest = F.max_by(F.struct(*order, *rest), F.struct(*order))
    else:
        newest = F.max(F.struct(*order, *rest))
    return rows.groupBy(*keys).agg(newest.alias("_last")).select(*keys, "_last.*")


def latest_as_of(changes: DataFrame, pk: list[str], until: Column, order: list[str] | None = None) -> DataFrame:
    """The table as it was when only the changes that meet ``until`` had arrived."""
    return latest(changes.where(until), pk, order)


def compact(m: DataFrame) -> DataFrame:
    """The last message of each key of a topic; deleted keys and messages without key are left out."""
    last = last_of(m.where(F.col("key").isNotNull()), ["topic", "key"], KEY_ORDER)
    return last.where(F.coalesce(F.length("value"), F.lit(0)) > 0).select(*ENVELOPE.names)


def latest_table(m: DataFrame, pk: Mapping[str, Column], schema: str, *, fmt: str = "json") -> DataFrame:
    """Current table of a keyed topic.

    Messages are reduced to the last one per key before any value is decoded.
    """
    last = last_of(m.where(F.col("key").isNotNull()).select("topic", "key", "value", *KEY_ORDER), ["topic", "key"], KEY_ORDER)
    rows = decode_upsert(last, pk, schema, fmt=fmt)
    return rows.where(~_deletes(F.col("row_kind"))).drop("row_kind")


def encode_upsert(changes: DataFrame, pk: list[str], columns: list[str], *, keep: list[str] | None = None) -> DataFrame:
    """Changelog rows -> key and value bytes; ``-D`` and ``-U`` become tombstones."""
    value = F.when(~_deletes(F.col("row_kind")), F.to_json(F.struct(*columns)).cast("binary"))
    return changes.select(F.to_json(F.struct(*pk)).cast("binary").alias("key"), value.alias("value"), *(keep or []))


def count_change(changes: DataFrame, by: list[str]) -> DataFrame:
    """Rows per group of the table behind a full changelog, by adding and retracting."""
    sign = F.when(_deletes(F.col("row_kind")), F.lit(-1)).otherwise(F.lit(1))
    return changes.groupBy(*by).agg(F.sum(sign).alias("count")).where(F.col("count") > 0)

