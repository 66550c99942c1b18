"""Topics as tables of databases.

A database is ``tenant/namespace``.  Databases named without a slash live under a
reserved tenant; they and their tables can be created and dropped here, while
databases and topics of other tenants are only read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F, types as T

from topiclake.catalog.connect import read_table
from topiclake.catalog.options import TableOptions
from topiclake.catalog.registry import REGISTRY_DDL, schema_of, struct_for
from topiclake.functions.topic_names import namespace_of, topic_parts
from topiclake.operators.decode import decode
from topiclake.sources.topics import scan

RESERVED_TENANT = "__lake_catalog"
TABLE_PREFIX = "table_"
#: topic that marks an otherwise empty database
_MARKER = "__database"
TABLE_TYPE = "TABLE"


class CatalogError(ValueError):
    """A catalog operation that is not allowed or does not apply."""


def is_generic(database: str) -> bool:
    return "/" not in database


def topic_name(database: str, table: str) -> str:
    """Topic behind a table."""
    if is_generic(database):
        return f"persistent://{RESERVED_TENANT}/{database}/{TABLE_PREFIX}{table}"
    return f"persistent://{database}/{table}"


def databases(registry: DataFrame) -> DataFrame:
    """All databases; those of the reserved tenant by their short name."""
    return registry.select(
        F.regexp_replace(namespace_of(F.col("topic")), f"^{RESERVED_TENANT}/", "").alias("database")
    ).distinct()


def tables(registry: DataFrame, database: str | None = None) -> DataFrame:
    """Tables ``database, table``; the partitions of a topic are one table."""
    parts = topic_parts(F.col("topic"))
    generic = parts.getField("tenant") == RESERVED_TENANT
    local = parts.getField("local_name")
    listed = (
        registry.where(local != _MARKER)
        .select(
            F.regexp_replace(namespace_of(F.col("topic")), f"^{RESERVED_TENANT}/", "").alias("database"),
            F.when(generic, F.regexp_replace(local, f"^{TABLE_PREFIX}", "")).otherwise(local).alias("table"),
        )
        .distinct()
    )
    return listed if database is None else listed.where(F.col("database") == database)


def database_exists(registry: DataFrame, database: str) -> bool:
    try:
        return bool(databases(registry).where(F.col("database") == database).take(1))
    except Exception:
        return False


def table_exists(registry: DataFrame, database: str, table: str) -> bool:
    return bool(tables(registry, database).where(F.col("table") == table).take(1))


def _add(registry: DataFrame, row: tuple[str, str, str, str]) -> DataFrame:
    return registry.unionByName(registry.sparkSession.createDataFrame([row], REGISTRY_DDL))


def create_database(registry: DataFrame, database: str, *, ignore_if_exists: bool = False) -> DataFrame:
    if not is_generic(database):
        raise CatalogError(f"{database} would be mapped from topics, it cannot be created")
    if database_exists(registry, database):
        if ignore_if_exists:
            return registry
        raise CatalogError(f"database {database} already exists")
    return _add(registry, (f"persistent://{RESERVED_TENANT}/{database}/{_MARKER}", "NONE", "", ""))


def drop_database(
    registry: DataFrame, database: str, *, cascade: bool = False, ignore_if_not_exists: bool = False
) -> DataFrame:
    if not is_generic(database):
        raise CatalogError(f"{database} is mapped from topics, it cannot be dropped")
    if not database_exists(registry, database):
        if ignore_if_not_exists:
            return registry
        raise CatalogError(f"database {database} does not exist")
    if tables(registry, database).take(1) and not cascade:
        raise CatalogError(f"database {database} is not empty")
    return registry.where(namespace_of(F.col("topic")) != f"{RESERVED_TENANT}/{database}")


def create_table(
    registry: DataFrame,
    database: str,
    table: str,
    schema: T.StructType,
    options: dict[str, str] | None = None,
    *,
    ignore_if_exists: bool = False,
    primary_key: list[str] | None = None,
    upsert: bool = False,
    metadata: dict[str, str] | None = None,
) -> DataFrame:
    """The registry with a new table; nothing is changed when its definition cannot be stored.

    ``primary_key``, ``upsert`` and ``metadata`` (column -> metadata of the message) are part of the definition.
    """
    if not is_generic(database):
        raise CatalogError(f"{database} is mapped from topics, tables cannot be created in it")
    if not database_exists(registry, database):
        raise CatalogError(f"database {database} does not exist")
    if table_exists(registry, database, table):
        if ignore_if_exists:
            return registry
        raise CatalogError(f"table {database}.{table} already exists")
    try:
        props = to_props(schema, options or {})
        if primary_key:
            props["primary-key"] = json.dumps(primary_key)
        if upsert:
            props["upsert"] = "true"
        if metadata:
            props["metadata"] = json.dumps(metadata)
        definition = json.dumps(props, sort_keys=True)
    except (TypeError, ValueError) as error:
        raise CatalogError(f"the definition of {table} cannot be stored") from error
    return _add(registry, (topic_name(database, table), TABLE_TYPE, definition, ""))


def drop_table(registry: DataFrame, database: str, table: str, *, ignore_if_not_exists: bool = False) -> DataFrame:
    if not is_generic(database):
        raise CatalogError(f"{table} is a mapped topic, it cannot be dropped")
    if not table_exists(registry, database, table):
        if ignore_if_not_exists:
            return registry
        raise CatalogError(f"table {database}.{table} does not exist")
    return registry.where(F.col("topic") != topic_name(database, table))


def to_props(schema: T.StructType, options: dict[str, str]) -> dict[str, str]:
    """A table definition as a map of strings."""
    for key, value in options.items():
        if not isinstance(key, str) or not isinstance(value, str):
            raise TypeError(f"option {key} must be text")
    return {"schema": schema.json(), **{f"option.{k}": v for k, v in options.items()}}


def from_props(props: dict[str, str]) -> tuple[T.StructType, dict[str, str]]:
    """Schema and options of a table; without a format the values are read raw."""
    options = {k.removeprefix("option."): v for k, v in props.items() if k.startswith("option.")}
    return T.StructType.fromJson(json.loads(props["schema"])), options


def table_definition(registry: DataFrame, database: str, table: str) -> tuple[T.StructType, dict[str, str]]:
    """Schema and options of a table, with the defaults filled in."""
    if not table_exists(registry, database, table):
        raise CatalogError(f"table {database}.{table} does not exist")
    entry = schema_of(registry, topic_name(database, table))
    if entry["schema_type"] == TABLE_TYPE:
        schema, options = from_props(json.loads(entry["definition"]))
        options = {"generic": "true", **options}
    else:
        schema, options = struct_for(entry), {}
    if "value.format" not in options and "format" not in options:
        options["format"] = "raw"
    return schema, options


def stored_options(registry: DataFrame, database: str, table: str) -> tuple[TableOptions, dict[str, str]]:
    """The options of a table that was created in the catalog, with its keys, and its metadata columns.

    Without a topic it is that of the table's own name; without a start it is read from the first message.
    """
    entry = schema_of(registry, topic_name(database, table))
    if entry["schema_type"] != TABLE_TYPE:
        raise CatalogError(f"{database}.{table} is a mapped topic, it has no options")
    schema, options = table_definition(registry, database, table)
    opts = {k: v for k, v in options.items() if k != "generic"}
    if not {"topic", "topic-pattern"} & set(opts):
        opts["topic"] = topic_name(database, table)
    opts.setdefault("scan.startup.mode", "earliest")
    props = json.loads(entry["definition"])
    keys = json.loads(props.get("primary-key", "[]"))
    return TableOptions(schema, opts, primary_key=keys, upsert=props.get("upsert") == "true"), json.loads(props.get("metadata", "{}"))


def as_table(
    log: DataFrame, registry: DataFrame, database: str, table: str, view: str | None = None, *, cursors: DataFrame | None = None
) -> DataFrame:
    """A topic as a table with the columns of its registry schema, optionally as a temp view.

    A table that was created in the catalog is read by all its options: formats of key and value, key fields, start, metadata
    columns, and as its current rows if it is an upsert table.
    """
    topic = topic_name(database, table)
    entry = schema_of(registry, topic)
    if entry["schema_type"] == TABLE_TYPE:
        options, metadata = stored_options(registry, database, table)
        return read_table(log, options, metadata, cursors=cursors, view=view)
    schema = struct_for(entry)
    fmt = {"JSON": "json", "AVRO": "avro"}.get(entry["schema_type"], "atomic")
    messages = scan(log, topic=topic)
    if fmt == "avro":
        out = decode(messages, entry["definition"], "avro").select("data.*")
    elif fmt == "json":
        out = decode(messages, schema, "json").select("data.*")
    else:
        if len(schema.fields) > 1:
            raise ValueError(f"a topic of type {entry['schema_type']} with columns {schema.names} needs a decoder, see decode")
        column = schema.fields[0]
        out = decode(messages, column.dataType, fmt).select(F.col("data").alias(column.name))
    if view:
        out.createOrReplaceTempView(view)
    return out


def unsupported(operation: str):
    """Operations a log catalog refuses: alter, rename, views, partitions, statistics."""
    raise NotImplementedError(f"{operation} is not supported by this catalog")
