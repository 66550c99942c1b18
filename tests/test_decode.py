from __future__ import annotations

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F, types as T

from topiclake.operators import decode as D
from topiclake.operators.assemble import assemble, metadata, with_key_prefix


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING").withColumn("value", F.col("value").cast("binary"))


def one(df):
    return df.first()["data"]


def test_fields_missing_unknown_and_empty(spark):
    m = texts(spark, '{"x": 1, "i": "", "s": "", "extra": {"a": [1, 2]}}')
    row = one(D.decode(m, "i INT, s STRING, f FLOAT, extra STRING"))
    # an empty text is NULL unless the field is a string; any token can be read as text
    assert (row.i, row.s, row.f) == (None, "", None)
    assert json.loads(row.extra) == {"a": [1, 2]}


def test_empty_text_in_strict_mode(spark):
    m = texts(spark, '{"i": "", "n": {"j" : ""}, "s": "a: \\"\\""}')
    row = one(D.decode(m, "i INT, n STRUCT<j: DOUBLE>, s STRING", mode="FAILFAST"))
    assert (row.i, row.n.j, row.s) == (None, None, 'a: ""')


def test_special_numbers(spark):
    row = one(D.decode(texts(spark, '{"a": "NaN", "b": "Infinity", "c": "-Infinity"}'), "a DOUBLE, b FLOAT, c DOUBLE"))
    assert math.isnan(row.a) and (row.b, row.c) == (math.inf, -math.inf)


def test_modes(spark):
    m = texts(spark, '{"i": 1}', '{"i": "x"}', "{")
    assert D.decode(m, "i INT").where("data.i IS NULL").count() == 2
    assert [r["data"].i for r in D.decode(m, "i INT", mode="dropmalformed").collect()] == [1]
    assert D.decode(m, "i INT", mode="nonsense").count() == 3
    assert D.decode(m, "i INT", options={"mode": "DROPMALFORMED"}).count() == 1
    with pytest.raises(Exception):
        D.decode(m, "i INT", mode="FAILFAST").collect()


def test_corrupt_column(spark):
    m = texts(spark, '{"i": 1}', "{")
    row = D.decode(m, "i INT, bad STRING", options={"columnNameOfCorruptRecord": "bad"}).where("data.bad IS NOT NULL")
    assert [r["data"].bad for r in row.collect()] == ["{"]
    good, bad = D.quarantine(m, "i INT")
    assert good.select("data.*").collect() == [(1,)]
    assert bad.count() == 1 and bad.columns == ["value", D.CORRUPT]


def test_times_and_formats(spark):
    m = texts(spark, '{"a": 90, "b": "2020-01-02T03:04:05.678", "d": "2020-01-02", "e": "05/06/2021"}')
    row = one(D.decode(m, "a TIMESTAMP, b TIMESTAMP, d DATE"))
    assert row.a == dt.datetime(1970, 1, 1, 0, 1, 30)
    assert row.b == dt.datetime(2020, 1, 2, 3, 4, 5, 678000)
    assert row.d == dt.date(2020, 1, 2)
    assert one(D.decode(m, "e DATE", options={"dateFormat": "dd/MM/yyyy"})).e == dt.date(2021, 6, 5)


def test_times_without_zone_and_times_of_day(spark):
    m = texts(spark, '{"n": 90, "m": "2020-01-02T03:04:05.678", "t": "01:02:03.5", "l": [60, null], "b": "AQI="}')
    row = one(D.decode(m, "n TIMESTAMP_NTZ, m TIMESTAMP_NTZ, t TIME(6), l ARRAY<TIMESTAMP_NTZ>, b BINARY"))
    assert row.n == dt.datetime(1970, 1, 1, 0, 1, 30) and row.m == dt.datetime(2020, 1, 2, 3, 4, 5, 678000)
    assert row.t == dt.time(1, 2, 3, 500000) and row.l == [dt.datetime(1970, 1, 1, 0, 1), None]
    assert bytes(row.b) == b"\x01\x02"
    assert one(D.decode(texts(spark, '{"t": "noon", "n": 1}'), "t TIME(6), n INT")) == (None, 1)


def test_option_rules():
    for bad in ({"lineSep": ""}, {"encoding": "UTF-16"}, {"encoding": "UTF-32"}, {"charset": "ISO-8859-1"}):
        with pytest.raises(ValueError):
            D.check_json_options(bad)
    for good in ({}, {"encoding": "UTF-8"}, {"encoding": "ISO-8859-1", "lineSep": "\n"}, {"encoding": "UTF-16", "multiLine": "true"}):
        D.check_json_options(good)


def test_nested_values(spark):
    ddl = "l ARRAY<STRUCT<b: BOOLEAN, s: STRING>>, m MAP<STRING, STRUCT<b: BOOLEAN>>, bar STRUCT<b: BOOLEAN, s: STRING>"
    m = texts(spark, '{"l": [{"b": true, "s": "x"}, null], "m": {"k": {"b": false}}, "bar": null}')
    row = one(D.decode(m, ddl))
    assert row.l[0].s == "x" and row.l[1] is None and row.m["k"].b is False and row.bar is None


ATOMIC = [
    ("BOOLEAN", T.BooleanType(), [True, False], ["01", "00"]),
    ("INT8", T.ByteType(), [1, -1, -128], ["01", "FF", "80"]),
    ("INT16", T.ShortType(), [1, -2], ["0001", "FFFE"]),
    ("INT32", T.IntegerType(), [1, -1, 2**31 - 1, -(2**31)], ["00000001", "FFFFFFFF", "7FFFFFFF", "80000000"]),
    ("INT64", T.LongType(), [5, -1, 2**63 - 1, -(2**63)], ["0000000000000005", "F" * 16, "7" + "F" * 15, "8" + "0" * 15]),
    ("FLOAT", T.FloatType(), [1.0, -2.5, 0.0, math.inf], ["3F800000", "C0200000", "00000000", "7F800000"]),
    ("DOUBLE", T.DoubleType(), [1.0, 5e-324, -1.7976931348623157e308, 0.1], ["3FF" + "0" * 13, "0" * 15 + "1", "FFEFFFFFFFFFFFFF", "3FB999999999999A"]),
    ("STRING", T.StringType(), ["a", ""], ["61", ""]),
    ("BYTES", T.BinaryType(), [b"\x01\x02"], ["0102"]),
    ("LOCAL_DATE", T.DateType(), [dt.date(1970, 1, 2), dt.date(1969, 12, 31)], ["0000000000000001", "F" * 16]),
    ("INSTANT", T.TimestampType(), [dt.datetime(1970, 1, 1, 0, 0, 1, 5)], ["0000000000000001" + "00001388"]),
    ("LOCAL_DATE_TIME", T.TimestampNTZType(), [dt.datetime(1970, 1, 2, 0, 0, 1)], ["0000000000000001" + "000000003B9ACA00"]),
]


@pytest.mark.parametrize("name, kind, values, wanted", ATOMIC, ids=[a[0] for a in ATOMIC])
def test_atomic(spark, name, kind, values, wanted):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None])], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", kind)]))
    packed = df.select("i", D.encode_atomic(F.col("v"), name).alias("b"))
    assert [r[0] for r in packed.orderBy("i").select(F.hex("b")).collect()] == [*wanted, None]
    back = packed.select("i", D.decode_atomic(F.col("b"), name).alias("v")).orderBy("i").collect()
    got = [bytes(r.v) if isinstance(r.v, bytearray) else r.v for r in back]
    assert got == [*values, None]


@pytest.mark.parametrize("name", ["INT32", "DOUBLE", "LOCAL_DATE", "BOOLEAN"])
def test_atomic_size_is_checked(spark, name):
    with pytest.raises(Exception, match="bytes, not 3"):
        spark.range(1).select(D.decode_atomic(F.lit(b"abc"), name)).collect()


def test_atomic_nan_and_time(spark):
    nan = spark.range(1).select(D.decode_atomic(D.encode_atomic(F.lit(float("nan")), "DOUBLE"), "DOUBLE").alias("x"))
    assert math.isnan(nan.first().x)
    df = spark.sql("SELECT time'01:02:03.25' AS t")
    packed = df.select(D.encode_atomic(F.col("t"), "LOCAL_TIME").alias("b"))
    assert packed.select(F.hex("b")).first()[0] == f"{(3723 * 10**9 + 250_000_000):016X}"
    assert packed.select(D.decode_atomic(F.col("b"), "LOCAL_TIME").cast("string").alias("t")).first().t == "01:02:03.25"
    with pytest.raises(ValueError):
        D.decode_atomic(F.lit(b""), "decimal(3,1)")


def test_raw_and_user_decoder(spark):
    m = texts(spark, "12,13", "7")
    assert one(D.decode(m.limit(1), "STRING", "raw")) == "12,13"
    several = D.decode(m, "", lambda d: d.withColumn("data", F.explode(F.split(F.col("value").cast("string"), ","))))
    assert sorted(r["data"] for r in several.collect()) == ["12", "13", "7"]
    with pytest.raises(ValueError):
        D.decode(m, "i INT", "csv")


@pytest.mark.parametrize("fmt, package", [("avro", "spark-avro"), ("protobuf", "spark-protobuf")])
def test_optional_codecs_name_their_package(spark, tmp_path, fmt, package):
    descriptor = tmp_path / "message.desc"
    descriptor.write_bytes(b"")
    schema = '{"type": "int"}' if fmt == "avro" else ("M", str(descriptor))
    with pytest.raises(RuntimeError, match=package):
        D.decode(texts(spark, "x"), schema, fmt)
    with pytest.raises(RuntimeError, match=package):
        D.encode(texts(spark, "x"), ["value"], fmt, schema=schema)


def test_key_overwrites_value_and_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "kid INT, vid INT, x INT")
    m = df.select(
        F.struct(F.col("kid").alias("id")).alias("k"), F.struct(F.col("vid").alias("id"), "x").alias("data"), F.lit(b"v").alias("value")
    )
    assert assemble(m, ["id", "x"], key="k", key_fields=["id"]).collect() == [(1, 3)]
    assert assemble(m, ["k_id", "id"], key="k", key_fields=["k_id"], key_prefix="k_").collect() == [(1, 2)]
    with pytest.raises(ValueError):
        assemble(m, ["nope"])
    assert with_key_prefix(df, "k_", ["x"]).columns == ["kid", "vid", "k_x"]


def test_missing_value_is_an_error_unless_upsert(spark):
    df = spark.sql("SELECT named_struct('id', 1) AS k, CAST(NULL AS STRUCT<x: INT>) AS data, CAST(NULL AS BINARY) AS value")
    with pytest.raises(Exception, match="not read in upsert mode"):
        assemble(df, ["id", "x"], key="k", key_fields=["id"]).collect()
    assert assemble(df, ["id", "x"], key="k", key_fields=["id"], upsert=True).collect() == [("-D", 1, None)]


def test_unknown_metadata(spark):
    with pytest.raises(ValueError):
        metadata(texts(spark, "x"), ["offset"])
