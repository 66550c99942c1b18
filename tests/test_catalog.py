from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F, types as T

from helpers import messages, rows
from topiclake.catalog import options as O, registry as R, tables as C
from topiclake.sources.topics import scan



def struct(ddl):
    return T.StructType.fromDDL(ddl)


# options --------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "options, text",
    [
        ({"topic": "a", "topic-pattern": "b"}, "shouldn't be set together"),
        ({}, "must be set"),
        ({"topic": "a", "scan.startup.mode": "newest"}, "Invalid value for option 'scan.startup.mode'"),
        ({"topic": "a", "scan.startup.mode": "external-subscription"}, "'scan.startup.sub-name' is required"),
        ({"topic": "a", "scan.startup.mode": "specific-offsets"}, "'scan.startup.specific-offsets' is required"),
        ({"topic": "a", "scan.startup.mode": "timestamp"}, "'scan.startup.timestamp-millis' is required"),
    ],
)
def test_source_options(options, text):
    with pytest.raises(O.OptionError, match=text):
        O.validate_source(options)


@pytest.mark.parametrize(
    "options, text",
    [
        ({"topic": "a;b"}, "single topic, but got 'topic'"),
        ({"topic-pattern": "a.*"}, "single topic, but got 'topic-pattern'"),
        ({"topic": "a", "sink.message-router": ""}, "non-empty string"),
        ({"topic": "a", "sink.semantic": "twice"}, "Unsupported value 'twice' for 'sink.semantic'"),
    ],
)
def test_sink_options(options, text):
    with pytest.raises(O.OptionError, match=text):
        O.validate_sink(options)


def test_good_options():
    O.validate_source({"topic": "a", "scan.startup.mode": "EARLIEST"})
    O.validate_source({"topic-pattern": "a.*"})
    O.validate_sink({"topic": "a", "sink.semantic": "exactly-once", "sink.message-router": "key-hash"})


def test_projections(spark):
    schema = struct("id INT, name STRING, age INT, address STRING")
    opts = {"key.format": "json", "key.fields": "address; name"}
    assert O.key_columns(schema, opts) == ["address", "name"]
    assert O.value_columns(schema, opts) == schema.names
    assert O.value_columns(schema, {**opts, "value.fields-include": "EXCEPT_KEY"}) == ["id", "age"]
    prefixed = struct("k_id INT, name STRING")
    opts = {"key.format": "json", "key.fields": "k_id", "key.fields-prefix": "k_", "value.fields-include": "EXCEPT_KEY"}
    assert (O.key_columns(prefixed, opts), O.value_columns(prefixed, opts)) == (["k_id"], ["name"])


@pytest.mark.parametrize(
    "options, text",
    [
        ({"key.fields": "id"}, "can only be declared if a key format is defined"),
        ({"key.format": "json"}, "requires the declaration of one or more of key fields"),
        ({"key.format": "json", "key.fields": "other"}, "Could not find the field 'other'"),
        (
            {"key.format": "json", "key.fields": "id", "key.fields-prefix": "k_", "value.fields-include": "EXCEPT_KEY"},
            "must be prefixed with 'k_'",
        ),
        ({"key.format": "json", "key.fields": "id", "key.fields-prefix": "i"}, "key prefix is not allowed"),
        ({"value.fields-include": "SOME"}, "Invalid value for option 'value.fields-include'"),
    ],
)
def test_projection_rules(spark, options, text):
    with pytest.raises(O.OptionError, match=text):
        O.TableOptions(struct("id INT, name STRING"), options)


def test_primary_key_rules(spark):
    schema = struct("id INT, name STRING")
    with pytest.raises(O.OptionError, match="doesn't support defining PRIMARY KEY"):
        O.TableOptions(schema, {"topic": "t", "format": "json"}, ["id"])
    O.TableOptions(schema, {"topic": "t", "format": "debezium-json"}, ["id"])
    with pytest.raises(O.OptionError, match="require to define a PRIMARY KEY"):
        O.TableOptions(schema, {"topic": "t"}, upsert=True)
    with pytest.raises(O.OptionError, match="topic list"):
        O.TableOptions(schema, {"topic": "a;b"}, ["id"], upsert=True)
    with pytest.raises(O.OptionError, match="not in insert-only mode"):
        O.TableOptions(schema, {"topic": "a", "value.format": "debezium-json"}, ["id"], upsert=True)
    with pytest.raises(O.OptionError, match="cannot be set"):
        O.TableOptions(schema, {"topic": "a", "key.fields": "id"}, ["id"], upsert=True)
    table = O.TableOptions(schema, {"Topic": "a", "scan.startup.mode": "latest"}, ["id"], upsert=True)
    assert table.key_columns == ["id"] and table.get("scan.startup.mode") == "earliest"
    assert table.topics == ["persistent://public/default/a"] and table.get("sink.semantic") == "at-least-once"


def test_option_helpers():
    assert O.with_prefix({"reader.queue": "1", "x": "2"}, O.READER_PREFIX) == {"queue": "1"}
    assert O.check_schema_mode("row") == "ROW"
    for bad in (None, "auto"):
        with pytest.raises(O.OptionError):
            O.check_schema_mode(bad)


# registry -------------------------------------------------------------------------------


def test_struct_and_registry_row(spark):
    schema = struct("id INT, tags ARRAY<STRING>, m MAP<STRING, BIGINT>, d DECIMAL(20,2), r STRUCT<b: BOOLEAN, t: TIMESTAMP>")
    row = dict(zip(struct(R.REGISTRY_DDL).names, R.registry_row_for("t", schema)))
    assert R.struct_for(row) == schema
    # without the DDL the definition itself gives the columns
    assert R.struct_for({**row, "ddl": ""}) == schema
    names = [f.name for f in R.struct_for(row, extended=True).fields]
    assert names[-5:] == R.META_COLUMNS
    assert R.registry_row_for("t", R.struct_for(row, extended=True)) == R.registry_row_for("t", schema)


def test_primitive_topics(spark):
    for kind in ("INT8", "INT64", "STRING", "BYTES", "LOCAL_DATE", "LOCAL_TIME", "INSTANT", "DOUBLE"):
        schema = R.struct_for({"schema_type": kind, "definition": "", "ddl": ""})
        assert schema.names == ["value"]
        assert R.registry_row_for("t", schema)[1] == kind
    with pytest.raises(R.IncompatibleSchema):
        R.struct_for({"schema_type": "KEY_VALUE", "definition": "", "ddl": ""})
    with pytest.raises(R.IncompatibleSchema, match="string keys"):
        R.registry_row_for("t", struct("a INT, m MAP<INT, INT>"))
    with pytest.raises(R.IncompatibleSchema):
        R.registry_row_for("t", struct("__key BINARY"))


def test_avro_unions(spark):
    definition = {
        "type": "record", "name": "r",
        "fields": [
            {"name": "a", "type": ["null", "string"]},
            {"name": "b", "type": ["int", "long"]},
            {"name": "c", "type": ["null", "float", "double"]},
            {"name": "d", "type": ["int", "string", "null"]},
            {"name": "e", "type": {"type": "enum", "name": "k", "symbols": ["X"]}},
            {"name": "f", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        ],
    }
    got = R.struct_for({"schema_type": "AVRO", "definition": json.dumps(definition), "ddl": None})
    kinds = {f.name: (f.dataType.simpleString(), f.nullable) for f in got.fields}
    assert kinds == {
        "a": ("string", True), "b": ("bigint", False), "c": ("double", True),
        "d": ("struct<member0:int,member1:string>", True), "e": ("string", False), "f": ("timestamp", False),
    }


@pytest.mark.parametrize("precision", range(1, 39))
def test_decimal_bytes(precision):
    size = R.decimal_bytes(precision)
    assert 10**precision - 1 < 2 ** (8 * size - 1)
    assert size == 1 or 10**precision > 2 ** (8 * (size - 1) - 1)


def test_agreement_and_compatibility(spark):
    reg = R.empty_registry(spark)
    reg = R.register_schema(reg, "a", struct("id INT, s STRING"), "JSON")
    reg = R.register_schema(reg, "b", struct("id INT, s STRING"), "JSON")
    reg = R.register_schema(reg, "c", struct("id BIGINT, s STRING"), "JSON")
    assert R.check_same_schema(reg, ["a", "b"])["schema_type"] == "JSON"
    assert R.check_same_schema(reg, [])["schema_type"] == "NONE"
    assert R.check_same_schema(reg, ["unknown"])["schema_type"] == "BYTES"
    for bad in (["a", "c"], ["a", "unknown"]):
        with pytest.raises(R.IncompatibleSchema, match="these have 2"):
            R.check_same_schema(reg, bad)
    # the same schema again changes nothing, another one is refused
    assert R.register_schema(reg, "a", struct("id INT, s STRING"), "JSON").count() == 3
    with pytest.raises(R.IncompatibleSchema, match="another schema"):
        R.register_schema(reg, "a", struct("id INT"), "JSON")
    none = {"schema_type": "NONE", "definition": ""}
    assert R.compatible(none, {"schema_type": "BYTES", "definition": ""})
    assert not R.compatible(none, {"schema_type": "STRING", "definition": ""})


# databases and tables -------------------------------------------------------------------


@pytest.fixture
def reg(spark):
    entries = [
        ("persistent://public/default/t", "JSON", "", "v INT"),
        ("persistent://public/default/p-partition-0", "INT32", "", ""),
        ("persistent://public/default/p-partition-1", "INT32", "", ""),
    ]
    return C.create_database(spark.createDataFrame(entries, R.REGISTRY_DDL), "mine")


def test_databases_and_tables(reg):
    assert rows(C.databases(reg), "database") == [("mine",), ("public/default",)]
    assert rows(C.tables(reg, "public/default"), "table") == [("p",), ("t",)]
    assert C.tables(reg, "mine").count() == 0
    assert C.database_exists(reg, "mine") and not C.database_exists(reg, "other")
    assert C.table_exists(reg, "public/default", "t") and not C.table_exists(reg, "mine", "t")


def test_create_and_drop(spark, reg):
    made = C.create_table(reg, "mine", "x", struct("v INT"), {"format": "json"})
    assert rows(C.tables(made, "mine"), "table") == [("x",)]
    schema, options = C.table_definition(made, "mine", "x")
    assert schema == struct("v INT") and options == {"generic": "true", "format": "json"}
    assert C.table_definition(C.create_table(reg, "mine", "y", struct("v STRING")), "mine", "y")[1]["format"] == "raw"
    assert C.create_table(made, "mine", "x", struct("v INT"), ignore_if_exists=True).count() == made.count()
    refused = [
        lambda: C.create_table(made, "mine", "x", struct("v INT")),
        lambda: C.create_table(made, "other", "x", struct("v INT")),
        lambda: C.create_table(made, "public/default", "x", struct("v INT")),
        lambda: C.create_table(made, "mine", "bad", struct("v INT"), {"n": 1}),
        lambda: C.drop_table(made, "public/default", "t"),
        lambda: C.drop_table(made, "mine", "nope"),
        lambda: C.create_database(made, "mine"),
        lambda: C.create_database(made, "a/b"),
        lambda: C.drop_database(made, "public/default"),
        lambda: C.drop_database(made, "mine"),
        lambda: C.drop_database(made, "nope"),
        lambda: C.table_definition(made, "mine", "nope"),
    ]
    for call in refused:
        with pytest.raises(C.CatalogError):
            call()
    assert not C.table_exists(C.drop_table(made, "mine", "x"), "mine", "x")
    assert C.drop_table(made, "mine", "nope", ignore_if_not_exists=True).count() == made.count()
    assert not C.database_exists(C.drop_database(made, "mine", cascade=True), "mine")
    assert C.drop_database(made, "nope", ignore_if_not_exists=True).count() == made.count()
    assert C.create_database(made, "mine", ignore_if_exists=True).count() == made.count()


def test_unsupported_operations():
    for operation in ("alter table", "rename table", "create view", "statistics"):
        with pytest.raises(NotImplementedError, match=operation):
            C.unsupported(operation)


def test_properties_round_trip(spark):
    schema, options = struct("a INT, b STRUCT<c: STRING>"), {"topic": "t", "format": "json"}
    assert C.from_props(json.loads(json.dumps(C.to_props(schema, options)))) == (schema, options)


def test_as_table(spark, reg):
    log = messages(spark, [(0, i, "k", f'{{"v": {i}}}', i) for i in range(5)])
    assert rows(C.as_table(log, reg, "public/default", "t", view="t_view"), "v") == [(i,) for i in range(5)]
    assert spark.sql("SELECT SUM(v) FROM t_view").first()[0] == 10
    numbers = log.withColumn("topic", F.lit("persistent://public/default/n")).withColumn("value", F.unhex(F.lit("00000007")))
    entry = spark.createDataFrame([("persistent://public/default/n", "INT32", "", "")], R.REGISTRY_DDL)
    assert C.as_table(numbers, entry, "public/default", "n").dtypes == [("value", "int")]
    assert C.as_table(numbers, entry, "public/default", "n").first().value == 7
    made = C.create_table(reg, "mine", "x", struct("line STRING"))
    raw = log.withColumn("topic", F.lit(C.topic_name("mine", "x")))
    assert C.as_table(raw, made, "mine", "x").first().line.startswith("{")
    # a topic that never registered a schema holds bytes
    assert C.as_table(log, R.empty_registry(spark), "public/default", "t").dtypes == [("value", "binary")]
    assert scan(log, topic="t").count() == 5


def test_stored_definitions_act(spark):
    """Key fields, start, metadata and upsert of a table that was created in the catalog."""
    made = C.create_database(R.empty_registry(spark), "mine")
    schema = T.StructType.fromDDL("k_id INT, v INT")
    keyed = {"format": "json", "key.format": "json", "key.fields": "k_id", "key.fields-prefix": "k_", "value.fields-include": "EXCEPT_KEY", "topic": "t"}
    made = C.create_table(made, "mine", "whole", schema, keyed, metadata={"when": "eventTime"})
    made = C.create_table(made, "mine", "late", schema, {**keyed, "scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": "1704067203000"})
    current = T.StructType.fromDDL("id INT, v INT")
    made = C.create_table(made, "mine", "current", current, {"format": "json", "value.fields-include": "EXCEPT_KEY", "topic": "t"}, primary_key=["id"], upsert=True)
    log = messages(spark, [(0, i, f'{{"id": {i % 2}}}', f'{{"v": {i}}}', i) for i in range(5)])
    assert rows(C.as_table(log, made, "mine", "whole"), "k_id", "v") == [(i % 2, i) for i in (0, 2, 4, 1, 3)]
    assert C.as_table(log, made, "mine", "whole").columns == ["k_id", "v", "when"]
    assert rows(C.as_table(log, made, "mine", "late"), "v") == [(3,), (4,)]
    assert rows(C.as_table(log, made, "mine", "current", view="current_rows"), "id", "v") == [(0, 4), (1, 3)]
    assert spark.sql("SELECT SUM(v) AS s FROM current_rows").first().s == 7
    with pytest.raises(C.CatalogError, match="mapped"):
        C.stored_options(R.empty_registry(spark), "public/default", "t")
