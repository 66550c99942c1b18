"""Queries: decoding and encoding of message bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.catalog.registry import schema_counts
from topiclake.checks import check
from topiclake.checks.topics import EV, EVENT_DDL, event_rows, events, lineitem, ntz, table
from topiclake.operators.assemble import value_only
from topiclake.operators.decode import CORRUPT, decode, decode_atomic, encode, encode_atomic, quarantine

#: a third of the values are made malformed, or lose a field, or carry an empty number
BROKEN = "CASE event_id % 3 WHEN 0 THEN 'cut' WHEN 1 THEN 'empty' ELSE 'whole' END"


def _broken(spark, folder):
    """Values of which every third is cut off and every third has an empty text for a number."""
    m = events(spark, folder).where("value IS NOT NULL")
    text = F.col("value").cast("string")
    number = F.col("sequence_id") % 3
    changed = F.when(number == 0, F.expr("substring(cast(value as string), 1, length(cast(value as string)) - 8)"))
    changed = changed.when(number == 1, F.regexp_replace(text, r'"value":[^,]*', '"value":""')).otherwise(text)
    return m.withColumn("value", changed.cast("binary"))


@check("decode_json", f"WITH {EV} SELECT event_id, event_type, value, props FROM ev WHERE NOT tombstone")
def decode_json(spark, folder):
    return event_rows(events(spark, folder)).select("data.*")


@check(
    "decode_json_mode",
    f"""WITH {EV}, v AS (SELECT * FROM ev WHERE NOT tombstone)
    SELECT 'PERMISSIVE' AS mode, COUNT(*) AS messages, COUNT(*) FILTER (WHERE event_id % 3 = 2) AS whole_numbers FROM v
    UNION ALL SELECT 'DROPMALFORMED', COUNT(*) FILTER (WHERE event_id % 3 <> 0), COUNT(*) FILTER (WHERE event_id % 3 = 2) FROM v""",
)
def decode_json_mode(spark, folder):
    m = _broken(spark, folder)
    out = []
    for mode in ("unknown means PERMISSIVE", "DROPMALFORMED"):
        rows = decode(m, "event_id BIGINT, event_type STRING, value DOUBLE", mode=mode)
        # a cut value may still give the fields before the cut
        whole = F.count_if((F.col("sequence_id") % 3 != 0) & F.col("data.value").isNotNull())
        name = "PERMISSIVE" if mode.startswith("unknown") else mode
        out.append(rows.agg(F.count("*").alias("messages"), whole.alias("whole_numbers")).select(F.lit(name).alias("mode"), "*"))
    return out[0].unionByName(out[1])


@check(
    "quarantine_malformed",
    f"""WITH {EV} SELECT event_id AS sequence_id, event_id % 3 = 0 AS malformed,
      CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type FROM ev WHERE NOT tombstone""",
)
def quarantine_malformed(spark, folder):
    good, bad = quarantine(_broken(spark, folder), EVENT_DDL)
    return good.select("sequence_id", F.lit(False).alias("malformed"), "data.event_type").unionByName(
        bad.select("sequence_id", F.col(CORRUPT).isNotNull().alias("malformed"), F.lit(None).cast("string").alias("event_type"))
    )


@check("encode_json", "SELECT l_orderkey, l_partkey, l_quantity, l_shipdate, l_returnflag FROM lineitem")
def encode_json(spark, folder):
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate", "l_returnflag"]
    rows = table(spark, folder, "lineitem").select(*columns)
    return decode(encode(rows, columns).select("value"), rows.schema).select("data.*")


@check("decode_raw", f"WITH {EV} SELECT sequence_id, key AS user_name, CAST(key AS BIGINT) AS user_id FROM ev")
def decode_raw(spark, folder):
    m = decode(events(spark, folder), "STRING", "raw", column="key", into="user_name")
    return decode(m, "BIGINT", "raw", column="key", into="user_id").select("sequence_id", "user_name", "user_id")


_ATOMIC = {
    "int64": ("bigint", "o_orderkey - 7000", "o_orderkey - 7000"),
    "int32": ("int", "CAST(o_custkey - 700 AS INT)", "CAST(o_custkey - 700 AS INTEGER)"),
    "int16": ("smallint", "CAST(o_custkey % 30000 - 9 AS SMALLINT)", "CAST(o_custkey % 30000 - 9 AS SMALLINT)"),
    "int8": ("tinyint", "CAST(o_orderkey % 200 - 100 AS TINYINT)", "CAST(o_orderkey % 200 - 100 AS TINYINT)"),
    "flag": ("boolean", "o_orderstatus = 'O'", "o_orderstatus = 'O'"),
    "price": ("double", "o_totalprice - 200000", "o_totalprice - 200000"),
    "ratio": ("float", "CAST(o_totalprice / 7 AS FLOAT)", "CAST(o_totalprice / 7 AS FLOAT)"),
    "status": ("string", "o_orderstatus", "o_orderstatus"),
    "day": ("date", "CAST(o_orderdate AS DATE)", "CAST(o_orderdate AS DATE)"),
    "moment": ("timestamp_ntz", "o_orderdate", "o_orderdate"),
}


@check(
    "decode_atomic",
    "SELECT o_orderkey, " + ", ".join(f"{sql} AS {name}" for name, (_, _, sql) in _ATOMIC.items()) + " FROM orders",
)
def decode_atomic_query(spark, folder):
    """Every primitive type through its bytes and back."""
    rows = table(spark, folder, "orders").select(
        "o_orderkey", *[F.expr(expr).alias(name) for name, (_, expr, _) in _ATOMIC.items()]
    )
    packed = rows.select(
        "o_orderkey", *[encode_atomic(F.col(name), kind).alias(name) for name, (kind, _, _) in _ATOMIC.items()]
    )
    return packed.select(
        "o_orderkey", *[decode_atomic(F.col(name), kind).alias(name) for name, (kind, _, _) in _ATOMIC.items()]
    )


@check(
    "encode_atomic",
    """SELECT o_orderkey, printf('%016X', o_orderkey) AS as_int64, printf('%08X', o_custkey) AS as_int32,
      printf('%016X', datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))) AS as_day FROM orders""",
)
def encode_atomic_query(spark, folder):
    rows = table(spark, folder, "orders")
    return rows.select(
        "o_orderkey",
        F.hex(encode_atomic(F.col("o_orderkey"), "INT64")).alias("as_int64"),
        F.hex(encode_atomic(F.col("o_custkey").cast("int"), "INT32")).alias("as_int32"),
        F.hex(encode_atomic(F.col("o_orderdate").cast("date"), "LOCAL_DATE")).alias("as_day"),
    )


@check("value_only", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def value_only_query(spark, folder):
    from topiclake.checks.topics import LINE_DDL

    return value_only(decode(lineitem(spark, folder), LINE_DDL))


@check(
    "schema_agreement",
    """SELECT o_orderpriority AS topic_group, COUNT(DISTINCT CASE WHEN o_custkey % 50 = 7 THEN 'BYTES' ELSE 'JSON' || o_orderstatus END) AS schemas,
      COUNT(DISTINCT o_custkey) AS topics FROM (SELECT o_orderpriority, o_custkey, MIN(o_orderstatus) AS o_orderstatus
      FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def schema_agreement(spark, folder):
    """Topics per customer and priority; every fiftieth customer never registered a schema."""
    topics = table(spark, folder, "orders").groupBy("o_orderpriority", "o_custkey").agg(F.min("o_orderstatus").alias("status"))
    name = F.concat_ws("-", F.lit("persistent://public/default/c"), "o_orderpriority", "o_custkey").alias("topic")
    named = topics.select(name, F.col("o_orderpriority").alias("topic_group"), "o_custkey", "status")
    registry = named.where("o_custkey % 50 <> 7").select(
        "topic", F.lit("JSON").alias("schema_type"), F.col("status").alias("definition"), F.lit("").alias("ddl")
    )
    return schema_counts(registry, named, ["topic_group"])


@check(
    "json_time_numbers",
    "SELECT o_orderkey, o_orderdate AS from_seconds, o_orderdate + INTERVAL 250 MILLISECOND AS from_text FROM orders",
)
def json_time_numbers(spark, folder):
    """A number in a time field is in seconds, a text follows the pattern."""
    day = F.col("o_orderdate").cast("timestamp")
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.unix_seconds(day).alias("from_seconds"),
        F.date_format(day + F.expr("INTERVAL '0.250' SECOND"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("from_text"),
    )
    schema = "o_orderkey BIGINT, from_seconds TIMESTAMP, from_text TIMESTAMP"
    return decode(encode(rows, rows.columns), schema).select(
        "data.o_orderkey", ntz("data.from_seconds").alias("from_seconds"), ntz("data.from_text").alias("from_text")
    )


@check(
    "json_lenient_options",
    f"WITH {EV} SELECT event_id, event_type, value FROM ev WHERE NOT tombstone",
)
def json_lenient_options(spark, folder):
    """Single quotes, names without quotes, comments, leading zeros and text in another encoding."""
    text = F.concat(
        F.lit("{event_id: 00"), F.col("event_id"), F.lit(", /* kind */ 'event_type': '"), F.col("event_type"),
        F.lit("', 'value': "), F.col("value"), F.lit("}"),
    )
    rows = table(spark, folder, "events").where("event_type <> 'error'").select(F.encode(text, "UTF-16BE").alias("value"))
    options = {
        "allowSingleQuotes": "true", "allowUnquotedFieldNames": "true", "allowComments": "true",
        "allowNumericLeadingZeros": "true", "encoding": "UTF-16BE", "multiLine": "true",
    }
    return decode(rows, "event_id BIGINT, event_type STRING, value DOUBLE", options=options).select("data.*")
