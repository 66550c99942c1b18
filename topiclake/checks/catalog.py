"""Queries: topics as databases and tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from topiclake.catalog.connect import insert_into, insert_stream, read_changelog, read_changelog_stream, read_table, read_table_stream
from topiclake.catalog.options import TableOptions
from topiclake.catalog.registry import REGISTRY_DDL, accepted
from topiclake.catalog.tables import RESERVED_TENANT, as_table, create_database, create_table, databases, drop_table, table_exists, tables
from topiclake.checks import check
from topiclake.checks.topics import EV, ORDERS, events, log, ntz, table
from topiclake.operators.sinks import write
from topiclake.plans.workspace import new_dir
from topiclake.sources.topics import read_log


def registry(spark, folder):
    """A registry with one partitioned topic per supplier: some under the reserved tenant."""
    supplier = F.col("s_suppkey")
    tenant = F.when(supplier % 2 == 0, F.lit(RESERVED_TENANT)).otherwise(F.concat(F.lit("tenant"), supplier % 5))
    prefix = F.when(supplier % 2 == 0, F.lit("table_")).otherwise(F.lit(""))
    suffix = F.when(supplier % 4 == 1, F.concat(F.lit("-partition-"), F.col("i"))).otherwise(F.lit(""))
    topic = F.concat(
        F.lit("persistent://"), tenant, F.lit("/ns"), F.col("s_nationkey"), F.lit("/"), prefix, F.lit("s"), supplier, suffix
    )
    rows = table(spark, folder, "supplier").withColumn("i", F.explode(F.array(F.lit(0), F.lit(1))))
    return rows.select(
        topic.alias("topic"), F.lit("BYTES").alias("schema_type"), F.lit("").alias("definition"), F.lit("value binary").alias("ddl")
    ).distinct()


_TABLES = """t AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'ns' || s_nationkey ELSE 'tenant' || (s_suppkey % 5) || '/ns' || s_nationkey END AS database,
  's' || s_suppkey AS "table" FROM supplier)"""


@check("list_databases", f"WITH {_TABLES} SELECT DISTINCT database FROM t")
def list_databases(spark, folder):
    return databases(registry(spark, folder))


@check("list_tables", f'WITH {_TABLES} SELECT DISTINCT database, "table" FROM t')
def list_tables(spark, folder):
    return tables(registry(spark, folder))


@check("register_table", "SELECT o_orderkey, o_totalprice FROM orders")
def register_table(spark, folder):
    """The orders topic under its registry schema as a view, asked in SQL."""
    entry = (ORDERS, "JSON", "", "o_orderkey BIGINT, o_totalprice DOUBLE")
    rows = spark.createDataFrame([entry], REGISTRY_DDL)
    as_table(log(spark, folder), rows, "public/default", "orders", view="orders_topic")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM orders_topic")


_USERS = {"topic": "events", "key.format": "raw", "value.format": "json", "value.fields-include": "EXCEPT_KEY"}


def users_table():
    """Last event per user, keyed by the user."""
    schema = T.StructType.fromDDL("user_id BIGINT, event_type STRING, value DOUBLE")
    return TableOptions(schema, _USERS, ["user_id"], upsert=True)


@check(
    "table_scan",
    """SELECT o_custkey AS k_customer, o_orderkey, o_totalprice, o_orderdate AS published, o_orderpriority AS priority
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""",
)
def table_scan(spark, folder):
    """A table over the orders topic from its options, with key, value and metadata columns, asked in SQL."""
    options = {
        "topic": "orders", "scan.startup.mode": "timestamp", "scan.startup.timestamp-millis": "852076800000",
        "key.format": "raw", "key.fields": "k_customer", "key.fields-prefix": "k_",
        "value.format": "json", "value.fields-include": "EXCEPT_KEY",
    }
    schema = T.StructType.fromDDL("k_customer BIGINT, o_orderkey BIGINT, o_totalprice DOUBLE")
    read_table(
        log(spark, folder), TableOptions(schema, options), {"published": "publishTime", "props": "properties"}, view="orders_table"
    )
    rows = spark.sql("SELECT k_customer, o_orderkey, o_totalprice, published, props['priority'] AS priority FROM orders_table")
    return rows.withColumn("published", ntz("published"))


@check(
    "table_upsert_scan",
    f"""WITH {EV}, last AS (SELECT user_id, MAX(event_id) AS event_id FROM ev GROUP BY 1)
    SELECT user_id, event_type, value FROM ev JOIN last USING (user_id, event_id) WHERE NOT tombstone""",
)
def table_upsert_scan(spark, folder):
    return read_table(events(spark, folder), users_table())


@check(
    "table_changelog",
    f"""WITH {EV}, s AS (SELECT user_id, tombstone, event_type, value, COALESCE(LAG(tombstone) OVER w, TRUE) AS gone,
      LAG(event_type) OVER w AS old_type, LAG(value) OVER w AS old_value FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    c AS (SELECT CASE WHEN tombstone AND NOT gone THEN ['-D'] WHEN tombstone THEN [] WHEN gone THEN ['+I']
      WHEN event_type <> old_type OR value <> old_value THEN ['-U', '+U'] ELSE [] END AS kinds FROM s)
    SELECT row_kind, COUNT(*) AS changes FROM (SELECT UNNEST(kinds) AS row_kind FROM c) GROUP BY 1""",
)
def table_changelog(spark, folder):
    return read_changelog(events(spark, folder), users_table()).groupBy("row_kind").agg(F.count("*").alias("changes"))


@check(
    "table_insert",
    """SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate AS "eventTime", o_orderstatus AS status FROM orders""",
)
def table_insert(spark, folder):
    """Insert rows with writable metadata and read them back through the same options."""
    options = {
        "topic": "inserted", "scan.startup.mode": "earliest", "key.format": "json", "key.fields": "o_custkey",
        "value.format": "json", "sink.message-router": "key-hash",
    }
    target = TableOptions(T.StructType.fromDDL("o_custkey BIGINT, o_orderkey BIGINT, o_totalprice DOUBLE"), options)
    rows = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("eventTime"),
        F.create_map(F.lit("status"), "o_orderstatus").alias("properties"),
    )
    path = new_dir(spark, "table")
    insert_into(rows, path, target, F.col("o_orderkey"), partitions=4)
    back = read_table(read_log(spark, path), target, ["eventTime", "properties"])
    return back.select(
        "o_custkey", "o_orderkey", "o_totalprice", ntz("eventTime").alias("eventTime"), F.col("properties")["status"].alias("status")
    )


@check(
    "table_exists",
    f"""WITH {_TABLES}, one AS (SELECT MIN(database) AS database FROM t)
    SELECT database, (SELECT MIN("table") FROM t JOIN one USING (database)) AS "table", true AS found FROM one
    UNION ALL SELECT database, 'not there', false FROM one""",
)
def tables_that_exist(spark, folder):
    """The first table of the first database, and one that is not there."""
    rows = registry(spark, folder)
    database = databases(rows).agg(F.min("database")).first()[0]
    name = tables(rows, database).agg(F.min("table")).first()[0]
    found = [(database, n, table_exists(rows, database, n)) for n in (name, "not there")]
    return spark.createDataFrame(found, "database STRING, table STRING, found BOOLEAN")


@check(
    "create_drop_table",
    f"""WITH {_TABLES} SELECT DISTINCT database, "table" FROM t UNION ALL SELECT 'made', 'stays'""",
)
def create_and_drop(spark, folder):
    """A database with two tables is added to the registry, one table is dropped again."""
    rows = create_database(registry(spark, folder), "made")
    schema = T.StructType.fromDDL("o_orderkey BIGINT, o_totalprice DOUBLE")
    for name in ("stays", "goes"):
        rows = create_table(rows, "made", name, schema, {"format": "json"})
    return tables(drop_table(rows, "made", "goes"))


@check(
    "schema_compat_check",
    "SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false ELSE true END AS accepted FROM supplier",
)
def schema_compat(spark, folder):
    """Writers declare one schema for topics that have it, another one, none, bytes, or (declaring none) bytes."""
    kind = F.col("s_suppkey") % 5
    topic = F.concat(F.lit("persistent://public/default/s"), "s_suppkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", topic.alias("topic"), kind.alias("kind"))
    row = lambda schema_type, definition: [schema_type.alias("schema_type"), definition.alias("definition"), F.lit("").alias("ddl")]
    stored = suppliers.where("kind <> 2").select(
        "topic",
        *row(F.when(F.col("kind") >= 3, "BYTES").otherwise("JSON"), F.when(F.col("kind") == 0, "a").when(F.col("kind") == 1, "b").otherwise("")),
    )
    last = F.col("kind") == 4
    declared = suppliers.select("topic", *row(F.when(last, "NONE").otherwise("JSON"), F.when(last, "").otherwise("a")))
    return accepted(stored, declared).join(suppliers, "topic").select("s_suppkey", "accepted")


@check(
    "stream_table_options",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def stream_table_options(spark, folder):
    """A stream from table to table: where it starts, what is decoded and how it is written come from options."""
    schema = T.StructType.fromDDL("o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING")
    path, copy, state = (new_dir(spark, n) for n in ("input", "copy", "state"))
    for i in range(2):
        write(log(spark, folder).where("topic like '%orders'").where(F.col("sequence_id") % 2 == i), path, commit=f"{i}")
    source = TableOptions(schema, {"topic": "orders", "format": "json", "scan.startup.mode": "earliest", "partition-discovery-interval-ms": "1000"})
    sink = TableOptions(schema, {"topic": "copy", "format": "json", "scan.startup.mode": "earliest", "sink.semantic": "exactly-once"})
    rows = read_table_stream(spark, path, source, state, files_per_batch=4)
    insert_stream(rows, copy, sink, F.col("o_orderkey"), new_dir(spark, "checkpoint"), partitions=3).awaitTermination()
    return read_table(read_log(spark, copy), sink)


@check(
    "stream_table_changelog",
    """WITH seen AS (SELECT *, LAG(o_orderkey) OVER w AS prev, LAG(o_orderstatus) OVER w AS ps, LAG(o_totalprice) OVER w AS pp
      FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
    changed AS (SELECT * FROM seen WHERE prev IS NOT NULL AND (o_orderstatus <> ps OR o_totalprice <> pp))
    SELECT '+I' AS row_kind, o_custkey, o_orderstatus, o_totalprice, o_orderkey FROM seen WHERE prev IS NULL
    UNION ALL SELECT '-U', o_custkey, ps, pp, o_orderkey FROM changed
    UNION ALL SELECT '+U', o_custkey, o_orderstatus, o_totalprice, o_orderkey FROM changed""",
)
def stream_table_changelog(spark, folder):
    """The last order of each customer as an upsert table, written in three commits and read as a stream of changes."""
    schema = T.StructType.fromDDL("o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")
    options = {"topic": "last-orders", "format": "json", "value.fields-include": "EXCEPT_KEY", "scan.startup.mode": "earliest"}
    target = TableOptions(schema, options, primary_key=["o_custkey"], upsert=True)
    path, out, state, checkpoint = (new_dir(spark, n) for n in ("upserts", "changes", "state", "checkpoint"))
    orders = table(spark, folder, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    for i in range(3):
        part = orders.where(F.expr(f"o_orderkey * 3 DIV {last + 1}") == i).select(*schema.names, "o_orderkey")
        insert_into(part, path, target, F.col("o_orderkey"), partitions=4)
    read_changelog_stream(
        spark, path, target, state, checkpoint, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/part={n}"), files_per_batch=8
    ).awaitTermination()
    return spark.read.parquet(out).select("row_kind", *schema.names, F.col("_entry_id").alias("o_orderkey"))
