"""Message bytes <-> typed columns, with Spark's own codecs.

``decode`` adds one struct column; Catalyst parses only the fields a query uses.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.avro import functions as avro
from pyspark.sql.protobuf import functions as protobuf

MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")
#: default name of the column that keeps the text of a malformed message
CORRUPT = "_corrupt_record"
#: fixed value: how a text timestamp is written unless an option says otherwise
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
# Fixed value: encodings whose line ends cannot be found byte by byte.
_WIDE_ENCODINGS = ("UTF-16", "UTF-32")
_BLANKS = "".join(map(chr, range(33)))


def as_struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def decode(
    m: DataFrame,
    schema: str | T.StructType,
    fmt: str | Callable[[DataFrame], DataFrame] = "json",
    *,
    column: str = "value",
    into: str = "data",
    mode: str = "PERMISSIVE",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Decode one bytes column of every message into the column ``into``.

    ``json``, ``avro`` and ``protobuf`` give a struct; ``raw`` and ``atomic`` give one
    value of the named type.  For avro the schema is the Avro definition, for protobuf
    ``(message name, descriptor file)``.  A function in place of a format gets the
    messages and returns them with ``into``; it may give several rows per message.
    """
    if callable(fmt):
        return fmt(m)
    source = F.col(column)
    fmt = fmt.lower()
    if fmt == "json":
        return _decode_json(m, source, as_struct(schema), into, mode, dict(options or {}))
    if fmt == "raw":
        return m.withColumn(into, decode_raw(source, schema))
    if fmt == "atomic":
        return m.withColumn(into, decode_atomic(source, schema))
    if fmt == "avro":
        return _optional("spark-avro", lambda: m.withColumn(into, avro.from_avro(source, schema, options or {})))
    if fmt == "protobuf":
        message, descriptor = schema
        return _optional(
            "spark-protobuf", lambda: m.withColumn(into, protobuf.from_protobuf(source, message, descriptor, options or {}))
        )
    raise ValueError(f"unknown format {fmt}")


def encode(
    df: DataFrame,
    columns: list[str],
    fmt: str = "json",
    *,
    schema: str | tuple[str, str] | None = None,
    into: str = "value",
) -> DataFrame:
    """Encode columns of a row into the bytes column ``into``."""
    row = F.struct(*columns)
    fmt = fmt.lower()
    if fmt in ("raw", "atomic") and len(columns) != 1:
        raise ValueError(f"format {fmt} holds one column, not {list(columns)}")
    if fmt == "json":
        return df.withColumn(into, F.to_json(row).cast("binary"))
    if fmt == "raw":
        return df.withColumn(into, F.col(columns[0]).cast("string").cast("binary"))
    if fmt == "atomic":
        return df.withColumn(into, encode_atomic(F.col(columns[0]), df.schema[columns[0]].dataType))
    if fmt == "avro":
        return _optional("spark-avro", lambda: df.withColumn(into, avro.to_avro(row, schema or "")))
    if fmt == "protobuf":
        return _optional("spark-protobuf", lambda: df.withColumn(into, protobuf.to_protobuf(row, *schema)))
    raise ValueError(f"unknown format {fmt}")


# JSON -----------------------------------------------------------------------------


def check_json_options(options: dict[str, str]) -> None:
    """The rules for encoding and line separator."""
    lowered = {k.lower(): v for k, v in options.items()}
    line_sep = lowered.get("linesep")
    if line_sep == "":
        raise ValueError("lineSep must not be empty")
    encoding = lowered.get("encoding", lowered.get("charset"))
    if encoding is None or lowered.get("multiline", "false").lower() == "true":
        return
    if encoding.upper() in _WIDE_ENCODINGS:
        raise ValueError(f"{encoding} text can only be read with multiLine")
    if encoding.upper() != "UTF-8" and line_sep is None:
        raise ValueError(f"{encoding} text needs a lineSep")


def parse_mode(mode: str | None) -> str:
    """Name of a parse mode; unknown names mean PERMISSIVE."""
    name = (mode or "").upper()
    return name if name in MODES else "PERMISSIVE"


def _field_names(kind: T.DataType, text: bool) -> set[str]:
    """Names of the struct fields at any depth that are (or are not) strings."""
    if isinstance(kind, T.StructType):
        found = {f.name for f in kind.fields if isinstance(f.dataType, T.StringType) == text}
        return found.union(*(_field_names(f.dataType, text) for f in kind.fields))
    if isinstance(kind, T.ArrayType):
        return _field_names(kind.elementType, text)
    if isinstance(kind, T.MapType):
        return _field_names(kind.valueType, text)
    return set()


def _empty_as_null(text: Column, schema: T.StructType) -> Column:
    """``"field": ""`` -> ``"field": null`` for fields that are not strings.

    Two quotes in a row after a colon can only be an empty value in JSON text.
    """
    names = sorted(_field_names(schema, False) - _field_names(schema, True))
    if not names:
        return text
    pattern = '("(?:' + "|".join(re.escape(n) for n in names) + ')"\\s*:\\s*)""'
    return F.when(F.contains(text, F.lit('""')), F.regexp_replace(text, pattern, "$1null")).otherwise(text)


def _parsed_as(kind: T.DataType) -> T.DataType:
    """The type from_json reads for a type it cannot read fully.

    A number in a time field is in seconds, which it only knows for TIMESTAMP; it does not know TIME.
    """
    if isinstance(kind, T.TimestampNTZType):
        return T.TimestampType()
    if isinstance(kind, T.TimeType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _parsed_as(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_parsed_as(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _parsed_as(kind.valueType), kind.valueContainsNull)
    return kind


def _from_json(text: Column, schema: T.StructType, options: dict[str, str]) -> Column:
    parsed = _parsed_as(schema)
    out = F.from_json(text, parsed, options)
    return out if parsed == schema else out.try_cast(schema)


def _decode_json(
    m: DataFrame, source: Column, schema: T.StructType, into: str, mode: str, options: dict[str, str]
) -> DataFrame:
    check_json_options(options)
    lowered = {k.lower(): k for k in options}
    mode = parse_mode(options.pop(lowered["mode"]) if "mode" in lowered else mode)
    if "timestampformat" not in lowered:
        options["timestampFormat"] = TIMESTAMP_FORMAT
    encoding = options.get(lowered.get("encoding", lowered.get("charset", "")), "UTF-8")
    text = source.cast("string") if encoding.upper() == "UTF-8" else F.decode(source, encoding)
    # blank text is NULL for from_json too, but said here the optimizer knows it: it assumes
    # that a struct of fields of a value that is not NULL is not NULL.  A brace settles it early.
    filled = F.contains(text, F.lit("{")) | (F.trim(text, F.lit(_BLANKS)) != "")
    text = F.when(filled, _empty_as_null(text, schema))
    if mode == "FAILFAST":
        return m.withColumn(into, _from_json(text, schema, {**options, "mode": "FAILFAST"}))
    parsed = {**options, "mode": "PERMISSIVE"}
    if mode == "PERMISSIVE":
        return m.withColumn(into, _from_json(text, schema, parsed))
    corrupt = options.get(lowered.get("columnnameofcorruptrecord", ""), CORRUPT)
    full = schema if corrupt in schema.names else T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed["columnNameOfCorruptRecord"] = corrupt
    out = m.withColumn(into, _from_json(text, full, parsed)).where(F.col(f"{into}.`{corrupt}`").isNull())
    return out if corrupt in schema.names else out.withColumn(into, F.col(into).dropFields(corrupt))


def quarantine(
    m: DataFrame, schema: str | T.StructType, *, column: str = "value", into: str = "data", corrupt: str = CORRUPT
) -> tuple[DataFrame, DataFrame]:
    """(messages that decode, messages that do not with their text in ``corrupt``)."""
    schema = as_struct(schema)
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    out = decode(m, full, "json", column=column, into=into, options={"columnNameOfCorruptRecord": corrupt})
    text = F.col(f"{into}.`{corrupt}`")
    good = out.where(text.isNull()).withColumn(into, F.col(into).dropFields(corrupt))
    bad = out.where(text.isNotNull()).select(*m.columns, text.alias(corrupt))
    return good, bad


# raw and atomic -------------------------------------------------------------------

_INT_BYTES = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}
# Bytes of the types that always have the same size.
_SIZES = {"boolean": 1, **_INT_BYTES, "float": 4, "double": 8, "date": 8, "time": 8, "timestamp_ntz": 16, "timestamp": 12}
_ALIASES = {
    "int8": "tinyint", "byte": "tinyint", "int16": "smallint", "short": "smallint", "int32": "int",
    "integer": "int", "int64": "bigint", "long": "bigint", "bytes": "binary", "none": "binary",
    "instant": "timestamp", "local_date": "date", "local_time": "time", "local_date_time": "timestamp_ntz",
}


def _type_name(schema: str | T.DataType) -> str:
    name = (schema if isinstance(schema, str) else schema.simpleString()).lower().strip()
    name = re.sub(r"^time\(\d\)$", "time", name)
    return _ALIASES.get(name, name)


def decode_raw(source: Column, kind: str | T.DataType = "string") -> Column:
    """The bytes as one column: text, or bytes as they are."""
    name = _type_name(kind)
    return source.cast("binary") if name == "binary" else source.cast("string").cast(name)


def _unsigned(source: Column, start: int, size: int) -> Column:
    """Up to four big-endian bytes from byte ``start`` (1-based)."""
    return F.conv(F.hex(F.substring(source, start, size)), 16, 10).cast("bigint")


def _signed(source: Column, start: int, size: int, name: str = "bigint") -> Column:
    if size == 8:
        high, low = _unsigned(source, start, 4), _unsigned(source, start + 4, 4)
        return F.shiftleft(high, 32).bitwiseOR(low).cast(name)
    top = F.lit(1 << (8 * size - 1)).cast("bigint")
    return (_unsigned(source, start, size).bitwiseXOR(top) - top).cast(name)


def _floating(source: Column, exponent_bits: int, fraction_bits: int) -> Column:
    """IEEE 754 bits as a DOUBLE; every step is exact because it scales by powers of two."""
    bits = _signed(source, 1, (1 + exponent_bits + fraction_bits) // 8)
    top, bias = (1 << exponent_bits) - 1, (1 << (exponent_bits - 1)) - 1
    sign = F.when(bits < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = F.shiftright(bits, fraction_bits).bitwiseAND(F.lit(top))
    fraction = bits.bitwiseAND(F.lit((1 << fraction_bits) - 1))
    scaled = fraction.cast("double") * F.lit(2.0**-fraction_bits)
    return (
        F.when((exponent == top) & (fraction != 0), F.lit(float("nan")))
        .when(exponent == top, sign * F.lit(float("inf")))
        .when(exponent == 0, sign * scaled * F.lit(2.0 ** (1 - bias)))
        .otherwise(sign * (scaled + 1.0) * F.pow(F.lit(2.0), (exponent - bias).cast("double")))
    )


def _day_second(day: Column, nanos: Column) -> Column:
    """Epoch day and nanos of the day -> TIMESTAMP."""
    return F.timestamp_micros(day * F.lit(86_400_000_000) + F.floor(nanos / 1000).cast("bigint"))


def decode_atomic(source: Column, kind: str | T.DataType) -> Column:
    """One primitive value.

    Integers, floats and epoch days or seconds are big-endian as the public client
    writes them: a date is an epoch day in 8 bytes, a time the nanos of the day in 8, a
    local date-time both in 16, an instant epoch seconds in 8 and nanos in 4.  The type
    TIME needs ``spark.sql.timeType.enabled``.
    """
    name = _type_name(kind)
    if name == "binary":
        return source.cast("binary")
    if name == "string":
        return source.cast("string")
    if name in _SIZES:
        wrong = F.concat(F.lit(f"size of a {name} is {_SIZES[name]} bytes, not "), F.length(source))
        source = F.when((F.length(source) != _SIZES[name]), F.raise_error(wrong).cast("binary")).otherwise(source)
    if name == "boolean":
        return F.hex(source) != "00"
    if name in _INT_BYTES:
        return _signed(source, 1, _INT_BYTES[name], name)
    if name == "float":
        return _floating(source, 8, 23).cast("float")
    if name == "double":
        return _floating(source, 11, 52)
    if name == "date":
        return F.date_from_unix_date(_signed(source, 1, 8, "int"))
    if name == "timestamp_ntz":
        return _day_second(_signed(source, 1, 8), _signed(source, 9, 8)).cast("timestamp_ntz")
    if name == "timestamp":
        seconds, nanos = _signed(source, 1, 8), _signed(source, 9, 4)
        return F.timestamp_micros(seconds * F.lit(1_000_000) + F.floor(nanos / 1000).cast("bigint"))
    if name == "time":
        moment = _day_second(F.lit(0).cast("bigint"), _signed(source, 1, 8))
        return F.date_format(moment, "HH:mm:ss.SSSSSS").cast("time(6)")
    raise ValueError(f"not an atomic type: {kind}")


def _big_endian(number: Column, size: int) -> Column:
    return F.unhex(F.right(F.lpad(F.hex(number.cast("bigint")), 16, "0"), F.lit(2 * size)))


def _float_bytes(value: Column, layout: str) -> Column:
    """IEEE 754 bytes; the function is sent by value, so executors need no extra package."""

    def pack(values: pd.Series) -> pd.Series:
        size = int(layout[-1])
        packed = values.to_numpy(f"float{8 * size}").astype(layout).tobytes()
        out = [packed[i : i + size] for i in range(0, len(packed), size)]
        return pd.Series(out, index=values.index, dtype=object)

    packed = F.pandas_udf(pack, T.BinaryType())
    return F.when(value.isNotNull(), packed(value))


def encode_atomic(value: Column, kind: str | T.DataType) -> Column:
    """The bytes ``decode_atomic`` reads; only floats leave the JVM, in Arrow batches."""
    name = _type_name(kind)
    day = F.lit(86_400_000_000)
    if name == "binary":
        return value
    if name == "string":
        return value.cast("binary")
    if name == "boolean":
        return F.when(value, F.lit(b"\x01")).when(~value, F.lit(b"\x00"))
    if name in _INT_BYTES:
        return _big_endian(value, _INT_BYTES[name])
    if name == "double":
        return _float_bytes(value, ">f8")
    if name == "float":
        return _float_bytes(value, ">f4")
    if name == "date":
        return _big_endian(F.unix_date(value), 8)
    if name == "timestamp_ntz":
        micros = F.unix_micros(value.cast("timestamp"))
        return F.concat(
            _big_endian(F.floor(micros / day), 8), _big_endian(F.pmod(micros, day) * 1000, 8)
        )
    if name == "timestamp":
        micros = F.unix_micros(value)
        million = F.lit(1_000_000)
        return F.concat(_big_endian(F.floor(micros / million), 8), _big_endian(F.pmod(micros, million) * 1000, 4))
    if name == "time":
        seconds = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
        nanos = F.rpad(F.regexp_extract(value.cast("string"), r"\.(\d+)$", 1), 9, "0").cast("bigint")
        return _big_endian(seconds.cast("bigint") * F.lit(1_000_000_000) + nanos, 8)
    raise ValueError(f"not an atomic type: {kind}")


# Avro and protobuf: Spark's optional modules -----------------------------------------


def _optional(package: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Use a module Spark ships separately; say which package is missing if it is."""
    try:
        return build()
    except (AnalysisException, TypeError, RuntimeError, OSError) as error:
        text = str(error)
        if "NOT_LOADED" in text or "JavaPackage" in text or "PROTOBUF" in text:
            raise RuntimeError(f"this format needs the {package} package on Spark's classpath") from error
        raise
