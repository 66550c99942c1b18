"""Rows of a table from the key, the value and the metadata of a message."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from topiclake.functions.times import ts_to_micros

#: SQL metadata columns, in their usual order
METADATA = ["topic", "messageId", "sequenceId", "publishTime", "eventTime", "properties"]


def message_id() -> Column:
    return F.struct("ledger_id", "entry_id", "batch_index", "partition")


def metadata_column(name: str) -> Column:
    """One metadata column; an unset event time reads as the epoch here."""
    columns = {
        "topic": F.col("topic"),
        "messageId": message_id(),
        "sequenceId": F.col("sequence_id"),
        "publishTime": F.col("publish_time"),
        "eventTime": F.timestamp_micros(ts_to_micros(F.col("event_time"))),
        "properties": F.col("properties"),
    }
    if name not in columns:
        raise ValueError(f"unknown metadata column {name}, there are {METADATA}")
    return columns[name]


def metadata(m: DataFrame, names: list[str] | Mapping[str, str]) -> DataFrame:
    """Metadata columns in any order; a mapping gives column name -> metadata it is read FROM."""
    pairs = names.items() if isinstance(names, Mapping) else ((n, n) for n in names)
    return m.select(*[metadata_column(source).alias(column) for column, source in pairs])


def extended(m: DataFrame) -> DataFrame:
    """All columns plus ``__key, __topic, __messageId, __publishTime, __eventTime``.

    Here an unset event time stays NULL.
    """
    return m.select(
        "*",
        F.col("key").alias("__key"),
        F.col("topic").alias("__topic"),
        message_id().alias("__messageId"),
        F.col("publish_time").alias("__publishTime"),
        F.col("event_time").alias("__eventTime"),
    )


def value_only(decoded: DataFrame, column: str = "data") -> DataFrame:
    """The decoded value alone; a struct becomes columns."""
    if decoded.schema[column].dataType.typeName() == "struct":
        return decoded.select(f"{column}.*")
    return decoded.select(F.col(column).alias("value"))


def with_key_prefix(df: DataFrame, prefix: str, columns: list[str] | None = None) -> DataFrame:
    """Key field ``x`` -> table column ``prefix + x``."""
    return df.withColumnsRenamed({c: prefix + c for c in (columns or df.columns)})


def assemble(
    decoded: DataFrame,
    physical: list[str],
    *,
    value: str = "data",
    value_fields: list[str] | None = None,
    key: str | None = None,
    keys: str | None = None,
    key_fields: list[str] | None = None,
    key_prefix: str = "",
    metadata_columns: list[str] | Mapping[str, str] = (),
    upsert: bool = False,
    carry: list[str] | None = None,
) -> DataFrame:
    """Rows of the ``physical`` columns followed by metadata and the columns to ``carry`` along.

    ``value`` names the decoded value struct, ``key`` the decoded key struct, or
    ``keys`` an array of key structs, each of which gets its own copy of the value.
    A key field overwrites a value field of the same name.  A message without value
    is an error unless the table is read in upsert mode, where it is a delete.
    """
    key_fields = key_fields or []
    rows = decoded
    if keys is not None:
        rows, key = rows.withColumn("_key", F.explode(keys)), "_key"
    if value_fields is None:
        value_fields = rows.schema[value].dataType.names
    out = []
    for column in physical:
        if column in key_fields:
            field = column.removeprefix(key_prefix)
            out.append(F.col(f"{key}.`{field}`").alias(column))
        elif column in value_fields:
            out.append(F.col(f"{value}.`{column}`").alias(column))
        else:
            raise ValueError(f"column {column} is neither a key nor a value field")
    pairs = metadata_columns.items() if isinstance(metadata_columns, Mapping) else ((n, n) for n in metadata_columns)
    out += [metadata_column(source).alias(column) for column, source in pairs]
    out += [F.col(column) for column in carry or []]
    if upsert:
        absent = F.col("value").isNull() | (F.length("value") == 0)
        return rows.select(F.when(absent, "-D").otherwise("+U").alias("row_kind"), *out)
    message = "a message has no value, but the table is not read in upsert mode"
    checked = F.when(F.col(value).isNull(), F.raise_error(F.lit(message))).otherwise(F.lit(True))
    return rows.where(checked).select(*out)
