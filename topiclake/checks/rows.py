"""Queries: table rows from key, value and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.catalog.options import key_columns, value_columns
from topiclake.checks import check
from topiclake.checks.topics import EV, EVENT_DDL, ORD, ORDER_DDL, events, json_bytes, log, ntz, orders, table, user_id
from topiclake.operators.assemble import assemble, extended, metadata, with_key_prefix
from topiclake.operators.decode import decode

_OPTIONS = {"key.format": "json", "key.fields": "o_orderpriority;o_custkey", "value.format": "json"}


@check("key_projection", "SELECT o_orderpriority, o_custkey FROM orders")
def key_projection(spark, folder):
    rows = table(spark, folder, "orders")
    return rows.select(*key_columns(rows.schema, _OPTIONS))


@check("value_projection", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def value_projection(spark, folder):
    rows = table(spark, folder, "orders")
    return rows.select(*value_columns(rows.schema, {**_OPTIONS, "value.fields-include": "EXCEPT_KEY"}))


@check("key_prefix", f"WITH {ORD} SELECT o_custkey AS k_id, o_orderkey AS id, o_totalprice FROM ord")
def key_prefix(spark, folder):
    """Key and value both own a field ``id``; the key's one is read as ``k_id``."""
    rows = table(spark, folder, "orders")
    m = rows.select(
        F.to_json(F.struct(F.col("o_custkey").alias("id"))).cast("binary").alias("key"),
        F.to_json(F.struct(F.col("o_orderkey").alias("id"), "o_totalprice")).cast("binary").alias("value"),
    )
    keys = decode(m, "id BIGINT", column="key", into="k")
    both = decode(keys, "id BIGINT, o_totalprice DOUBLE")
    key_part = with_key_prefix(both.select("k.*", "data"), "k_", ["id"])
    return key_part.select("k_id", "data.id", "data.o_totalprice")


@check(
    "assemble_row",
    f"""WITH {ORD} SELECT o_custkey AS k_customer, o_orderkey, o_totalprice, topic, publish_time AS published FROM ord""",
)
def assemble_row(spark, folder):
    m = decode(orders(spark, folder), ORDER_DDL).withColumn("k", F.struct(user_id().alias("customer")))
    out = assemble(
        m,
        ["k_customer", "o_orderkey", "o_totalprice"],
        key="k",
        key_fields=["k_customer"],
        key_prefix="k_",
        metadata_columns={"topic": "topic", "published": "publishTime"},
    )
    return out.withColumn("published", ntz("published"))


@check(
    "multi_key_fanout",
    "SELECT UNNEST([o_custkey, o_custkey + 1000000]) AS customer, o_orderkey, o_totalprice FROM orders",
)
def multi_key_fanout(spark, folder):
    rows = table(spark, folder, "orders")
    both = F.array(
        F.struct(F.col("o_custkey").alias("customer")), F.struct((F.col("o_custkey") + 1000000).alias("customer"))
    )
    m = rows.select(F.to_json(both).cast("binary").alias("key"), json_bytes("o_orderkey", "o_totalprice").alias("value"))
    m = m.withColumn("ks", F.from_json(F.col("key").cast("string"), "array<struct<customer: bigint>>"))
    m = decode(m, "o_orderkey BIGINT, o_totalprice DOUBLE")
    return assemble(m, ["customer", "o_orderkey", "o_totalprice"], keys="ks", key_fields=["customer"])


@check(
    "metadata_columns",
    f"""WITH {EV} SELECT topic, ledger_id, entry_id, batch_index, partition, sequence_id AS seq, publish_time AS published,
      COALESCE(event_time, TIMESTAMP '1970-01-01') AS occurred, event_type AS kind FROM ev""",
)
def metadata_columns(spark, folder):
    names = {
        "props": "properties", "occurred": "eventTime", "seq": "sequenceId", "topic": "topic", "id": "messageId",
        "published": "publishTime",
    }
    return metadata(events(spark, folder), names).select(
        "topic", "id.*", "seq", ntz("published").alias("published"), ntz("occurred").alias("occurred"),
        F.col("props")["type"].alias("kind"),
    )


@check(
    "extended_columns",
    f"""WITH {EV} SELECT key AS __key, topic AS __topic, ledger_id, entry_id, batch_index, partition,
      publish_time AS __publishTime, event_time AS __eventTime FROM ev""",
)
def extended_columns(spark, folder):
    return extended(events(spark, folder)).select(
        F.col("__key").cast("string").alias("__key"), "__topic", "__messageId.*",
        ntz("__publishTime").alias("__publishTime"), ntz("__eventTime").alias("__eventTime"),
    )


@check(
    "computed_columns",
    f"""WITH {ORD} SELECT o_orderkey + 1 AS next_key, o_totalprice + 1.0 AS price_plus, LOWER(o_orderpriority) AS priority,
      publish_time + INTERVAL 1 SECOND AS ts FROM ord""",
)
def computed_columns(spark, folder):
    rows = decode(orders(spark, folder), ORDER_DDL).select("data.*", "publish_time")
    return rows.selectExpr(
        "o_orderkey + 1 AS next_key", "o_totalprice + 1.0D AS price_plus", "lower(o_orderpriority) AS priority",
        "cast(publish_time + INTERVAL 1 SECOND AS timestamp_ntz) AS ts",
    )


@check(
    "nested_projection",
    f"""WITH {EV} SELECT event_id, event_type AS kind, CAST(json_extract(props, '$.k') AS BIGINT) AS k, step
    FROM (SELECT *, UNNEST([1, 2]) AS step FROM ev) WHERE NOT tombstone""",
)
def nested_projection(spark, folder):
    """Struct, array and map fields of a JSON value."""
    src = table(spark, folder, "events").where("event_type <> 'error'")
    k = F.from_json("props", "k BIGINT")
    value = F.struct(
        "event_id",
        F.struct(F.col("event_type").alias("kind")).alias("info"),
        F.array(F.struct(F.lit(1).alias("step")), F.struct(F.lit(2).alias("step"))).alias("steps"),
        F.create_map(F.lit("props"), k).alias("extra"),
    )
    m = src.select(F.to_json(value).cast("binary").alias("value"))
    ddl = "event_id BIGINT, info STRUCT<kind: STRING>, steps ARRAY<STRUCT<step: INT>>, extra MAP<STRING, STRUCT<k: BIGINT>>"
    rows = decode(m, ddl).select("data.*")
    return rows.select("event_id", "info.kind", F.col("extra")["props"]["k"].alias("k"), F.explode("steps.step").alias("step"))


@check(
    "message_filter",
    f"""WITH {EV} SELECT event_id, value, partition FROM ev
    WHERE partition = 2 AND publish_time >= TIMESTAMP '2024-01-10' AND NOT tombstone AND value > 20""",
)
def message_filter(spark, folder):
    m = log(spark, folder).where(
        (F.col("topic").endswith("/events")) & (F.col("partition") == 2) & (F.col("publish_time") >= "2024-01-10") & F.col("value").isNotNull()
    )
    return decode(m, EVENT_DDL).where("data.value > 20").select("data.event_id", "data.value", "partition")
