"""Tables over topics, from their options: what is scanned, decoded, encoded and routed."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from topiclake.catalog.options import TableOptions, validate_sink, validate_source
from topiclake.catalog.registry import avro_definition, check_same_schema, register_schema
from topiclake.envelope import KEY_ORDER, LOG
from topiclake.functions.positions import parse_positions
from topiclake.operators.assemble import METADATA, assemble
from topiclake.operators.changelog import latest, normalize
from topiclake.operators.decode import decode, encode
from topiclake.operators.sinks import to_messages, write
from topiclake.plans.bounded import small_rows, small_side
from topiclake.sources.manifest import files, high_water as manifest_marks, log_path
from topiclake.sources.starts import captured_marks, high_water, kept_cursors, with_start
from topiclake.sources.topics import partitions, read_log, scan, stream_log
from topiclake.streaming.sinks import ERROR, write_stream
from topiclake.streaming.upsert import normalize_stream


def _key_names(table: TableOptions) -> dict[str, str]:
    """Key column -> its name inside the key."""
    prefix = table.options.get("key.fields-prefix", "")
    return {c: c.removeprefix(prefix) for c in table.key_columns}


def _part(table: TableOptions, columns: list[str], names: Mapping[str, str] | None = None) -> T.StructType:
    names = names or {}
    return T.StructType([T.StructField(names.get(c, c), table.schema[c].dataType) for c in columns])


def _decoded(m: DataFrame, schema: T.StructType, fmt: str, column: str, into: str) -> DataFrame:
    """Key or value as a struct, also for formats of a single column."""
    if fmt == "json":
        return decode(m, schema, fmt, column=column, into=into)
    if fmt == "avro":
        return decode(m, json.dumps(avro_definition(schema)), fmt, column=column, into=into)
    if len(schema.fields) > 1:
        raise ValueError(f"format {fmt} holds one column, not {schema.names}: name a format, or leave columns out")
    field = schema.fields[0]
    out = decode(m, field.dataType, fmt, column=column, into=into)
    return out.withColumn(into, F.when(F.col(into).isNotNull(), F.struct(F.col(into).alias(field.name))))


def _stored_marks(spark: SparkSession, path: str, table: TableOptions) -> DataFrame:
    """High-water marks of the table's topics from the positions that commits keep; no message is read."""
    rows = files(spark, path)
    return manifest_marks(scan(rows, topics=table.topics) if "topic" in table.options else scan(rows, pattern=table.options["topic-pattern"]))


def _messages(
    log: DataFrame, table: TableOptions, marks: DataFrame | None, cursors: DataFrame | None, cursor_path: str | None = None
) -> DataFrame:
    """The messages a scan of the table covers."""
    opts = table.options
    validate_source(opts)
    m = scan(log, topics=table.topics) if "topic" in opts else scan(log, pattern=opts["topic-pattern"])
    mode = (table.get("scan.startup.mode") or "latest").lower()
    positions = None
    if marks is None and not m.isStreaming and mode not in ("earliest", "timestamp") and (path := log_path(log)):
        marks = small_side(_stored_marks(log.sparkSession, path, table))
    if cursor_path is not None and mode == "external-subscription":
        marks = small_side(high_water(m)) if marks is None else marks
        cursors = kept_cursors(log.sparkSession, cursor_path, marks, opts["scan.startup.sub-name"], table.get("scan.startup.sub-start-offset"))
    if mode == "specific-offsets":
        marks = high_water(m) if marks is None else marks
        found = parse_positions(log.sparkSession, opts["scan.startup.specific-offsets"])
        at = F.struct("ledger_id", "entry_id", F.lit(-1).alias("batch_index")).alias("start")
        positions = marks.select(*LOG).join(found, "partition").select(*LOG, at)
    millis = opts.get("scan.startup.timestamp-millis")
    return with_start(
        m,
        mode,
        marks=marks,
        positions=positions,
        cursors=cursors,
        subscription=opts.get("scan.startup.sub-name"),
        default=table.get("scan.startup.sub-start-offset"),
        timestamp_ms=None if millis is None else int(millis),
        data_loss="fail" if (table.get("failondataloss") or "").lower() == "true" else "last",
    )


def _rows(m: DataFrame, table: TableOptions, metadata: list[str] | Mapping[str, str]) -> DataFrame:
    keys, values = _key_names(table), table.value_columns
    rows = _decoded(m, _part(table, values), table.value_format or "raw", "value", "data")
    if keys:
        rows = _decoded(rows, _part(table, list(keys), keys), table.options.get("key.format", "json"), "key", "_k")
    order = {f"_{c}": F.col(c) for c in KEY_ORDER} if table.upsert else {}
    out = assemble(
        rows.withColumns(order) if order else rows,
        table.schema.names,
        value_fields=values,
        key="_k" if keys else None,
        key_fields=list(keys),
        key_prefix=table.options.get("key.fields-prefix", ""),
        metadata_columns=metadata,
        upsert=table.upsert,
        carry=list(order),
    )
    return out


def read_table(
    log: DataFrame,
    table: TableOptions,
    metadata: list[str] | Mapping[str, str] = (),
    *,
    marks: DataFrame | None = None,
    cursors: DataFrame | None = None,
    cursor_path: str | None = None,
    registry: DataFrame | None = None,
    view: str | None = None,
) -> DataFrame:
    """Rows of a table: its physical columns, then metadata columns.

    A start at a subscription takes its ``cursors``, or those stored at ``cursor_path``, where a first read leaves some.
    With a schema ``registry`` all topics of the table must have one schema.
    An upsert table gives its current rows.  ``view`` registers the table for SQL.
    """
    m = _messages(log, table, marks, cursors, cursor_path)
    if registry is not None:
        names = table.topics or [r["topic"] for r in small_rows(m.select("topic").distinct()) or ()]
        check_same_schema(registry, names)
    rows = _rows(m, table, metadata)
    if table.upsert:
        order = [f"_{c}" for c in KEY_ORDER]
        rows = latest(rows, table.primary_key, order).drop(*order)
    if view:
        rows.createOrReplaceTempView(view)
    return rows


def read_changelog(log: DataFrame, table: TableOptions) -> DataFrame:
    """An upsert table as ``+I -U +U -D`` rows with the columns that order them."""
    if not table.upsert:
        raise ValueError("only an upsert table has a changelog")
    rows = _rows(_messages(log, table, None, None), table, [])
    columns = [c for c in table.schema.names if c not in table.primary_key]
    return normalize(rows, table.primary_key, [f"_{c}" for c in KEY_ORDER], columns)


def insert_messages(
    rows: DataFrame,
    table: TableOptions,
    sequence: Column,
    *,
    partitions: int = 0,
    ledger_id: Column | int = 0,
    publish_time: Column | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Rows as messages of the table's topic.

    Columns ``eventTime`` and ``properties`` outside the schema are written as metadata.
    An upsert table takes ``row_kind`` rows, routes by key and writes tombstones.
    """
    validate_sink(table.options)
    keys = _key_names(table)
    extra = [c for c in rows.columns if c not in table.schema.names]
    read_only = [c for c in METADATA if c in extra and c not in ("eventTime", "properties")]
    if read_only:
        raise ValueError(f"metadata columns {read_only} are read-only")
    if len(table.value_columns) > 1 and (table.value_format or "raw") in ("raw", "atomic"):
        raise ValueError(f"format {table.value_format or 'raw'} holds one column, not {table.value_columns}: name a format")
    out = encode(rows, table.value_columns, table.value_format or "raw", into="_value")
    if keys:
        named = out.withColumns({f"_k_{n}": F.col(c) for c, n in keys.items()})
        fmt = table.options.get("key.format", "json")
        if fmt == "json":
            packed = F.to_json(F.struct(*[F.col(f"_k_{n}").alias(n) for n in keys.values()])).cast("binary")
            out = named.withColumn("_key", packed)
        else:
            if len(keys) > 1:
                raise ValueError(f"a key in format {fmt} holds one column, not {list(keys)}")
            out = encode(named, [f"_k_{next(iter(keys.values()))}"], fmt, into="_key")
    value = F.col("_value")
    if table.upsert and "row_kind" in rows.columns:
        value = F.when(~F.col("row_kind").isin("-D", "-U"), value)
    router = "key-hash" if table.upsert else table.options.get("sink.message-router", "round-robin")
    return to_messages(
        out,
        topic=table.topics[0],
        value=value,
        key=F.col("_key") if keys else None,
        sequence=sequence,
        ledger_id=ledger_id,
        publish_time=publish_time,
        event_time=F.col("eventTime") if "eventTime" in extra else None,
        properties=F.col("properties") if "properties" in extra else None,
        delay_ms=int(table.options.get("properties.send-delay-millisecond", "0")),
        partitions=partitions,
        router=router,
        mark=mark,
    )


def declare(registry: DataFrame | None, table: TableOptions) -> None:
    """Refuse to write a table whose topic has another schema than its values: nothing is written then.

    Formats without a schema of their own are bytes to the registry and are not checked.
    """
    kind = {"json": "JSON", "avro": "AVRO"}.get(table.value_format or "")
    if registry is not None and kind is not None:
        register_schema(registry, table.topics[0], _part(table, table.value_columns), kind)


def insert_into(
    rows: DataFrame,
    path: str,
    table: TableOptions,
    sequence: Column,
    *,
    commit: str | None = None,
    registry: DataFrame | None = None,
    **settings,
) -> bool:
    """Write rows to the table's topic in the log at ``path``, as one commit.

    Unless a ``ledger_id`` is given the commit is a ledger of its own, after those before it.  With a schema ``registry`` the
    topic must have no schema yet or that of the table.
    """
    declare(registry, table)
    writers = table.options.get("sink.parallelism")
    messages = insert_messages(rows, table, sequence, **settings)
    return write(
        messages, path, commit=commit, parallelism=int(writers) if writers else None, new_ledger="ledger_id" not in settings
    )


def read_table_stream(
    spark: SparkSession,
    path: str,
    table: TableOptions,
    state_path: str,
    metadata: list[str] | Mapping[str, str] = (),
    *,
    cursors: DataFrame | None = None,
    cursor_path: str | None = None,
    files_per_batch: int | None = None,
    registry: DataFrame | None = None,
) -> DataFrame:
    """Rows of a table as a stream over the log at ``path``, from the table's options alone.

    The start of the first run is kept below ``state_path``.  Without partition discovery
    (``partition-discovery-interval-ms`` of 0 or less) partitions that come later are not read.  With a schema ``registry``
    all topics of the table that are there must have one schema.
    """
    if table.upsert:
        raise ValueError("an upsert table is a changelog: use read_changelog_stream, or normalize_stream over its decoded stream")
    return _stream_rows(spark, path, table, state_path, metadata, cursors, files_per_batch, registry, cursor_path)


def _stream_rows(
    spark: SparkSession, path: str, table: TableOptions, state_path: str, metadata: list[str] | Mapping[str, str],
    cursors: DataFrame | None, files_per_batch: int | None, registry: DataFrame | None, cursor_path: str | None = None,
) -> DataFrame:
    stored = read_log(spark, path)
    known = scan(stored, topics=table.topics) if "topic" in table.options else scan(stored, pattern=table.options["topic-pattern"])
    if registry is not None:
        names = table.topics or [r["topic"] for r in _stored_marks(spark, path, table).select("topic").distinct().collect()]
        check_same_schema(registry, names)
    only = partitions(known) if int(table.get("partition-discovery-interval-ms")) <= 0 else None
    mode = (table.get("scan.startup.mode") or "latest").lower()
    marks = None
    if mode not in ("earliest", "timestamp"):
        marks = captured_marks(known, f"{state_path}/marks", lambda: _stored_marks(spark, path, table))
    return _rows(_messages(stream_log(spark, path, files_per_batch, only), table, marks, cursors, cursor_path), table, metadata)


def read_changelog_stream(
    spark: SparkSession,
    path: str,
    table: TableOptions,
    state_path: str,
    checkpoint: str,
    emit: Callable[[DataFrame, int], None],
    *,
    cursors: DataFrame | None = None,
    files_per_batch: int | None = None,
    registry: DataFrame | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """``read_changelog`` of an upsert table as a stream: ``emit(changes, batch_id)`` gets the ``+I -U +U -D`` rows of each micro-batch.

    The start of the first run and the last row of every key are kept below ``state_path``.
    """
    if not table.upsert:
        raise ValueError("only an upsert table has a changelog")
    rows = _stream_rows(spark, path, table, state_path, [], cursors, files_per_batch, registry)
    columns = [c for c in table.schema.names if c not in table.primary_key]
    return normalize_stream(
        rows, table.primary_key, f"{state_path}/keys", checkpoint, emit, order=[f"_{c}" for c in KEY_ORDER], columns=columns, available_now=available_now
    )


def insert_stream(
    rows: DataFrame, path: str, table: TableOptions, sequence: Column, checkpoint: str | None = None, *, quarantine_path: str | None = None,
    registry: DataFrame | None = None, **settings
) -> StreamingQuery:
    """Write a stream of rows to the table's topic; the options say how safely (``sink.semantic``, ``fail-on-write``).

    Unless a ``ledger_id`` is given every micro-batch is a ledger of its own, after all commits before it, as with ``insert_into``.
    """
    declare(registry, table)
    strict = table.get("fail-on-write").lower() == "true"
    return write_stream(
        insert_messages(rows, table, sequence, mark=None if strict else ERROR, **settings), path, checkpoint, table.get("sink.semantic"),
        fail_on_write=strict, quarantine_path=quarantine_path, new_ledger="ledger_id" not in settings,
    )
