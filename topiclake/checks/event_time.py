"""Queries: windows, watermarks, late rows and read progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from topiclake.checks import check
from topiclake.checks.topics import EV, event_rows, events, lineitem, ntz
from topiclake.envelope import LOG
from topiclake.operators import eventtime as E
from topiclake.sources.starts import high_water

CUT = "TIMESTAMP '2024-01-20 00:00:00'"
#: SQL: rows with the micro-batch they arrive in, a hundred ids each; every ninth row is two hours behind
ARRIVED = f"""{EV}, arrived AS (SELECT *, event_id // 100 AS batch,
  publish_time - CASE WHEN event_id % 9 = 0 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS rowtime FROM ev)"""
#: SQL: watermark after each batch over all partitions
MARKS = """grid AS (SELECT b.batch, p.partition FROM (SELECT DISTINCT batch FROM arrived) b, (SELECT DISTINCT partition FROM arrived) p),
per AS (SELECT batch, partition, MAX(rowtime) AS seen FROM {rows} GROUP BY ALL),
run AS (SELECT batch, partition, MAX(seen) OVER (PARTITION BY partition ORDER BY batch) AS high FROM grid LEFT JOIN per USING (batch, partition)),
marks AS (SELECT batch, MIN(high) AS low, COUNT(high) AS ready, COUNT(*) AS known FROM run GROUP BY 1)"""


def arrived(spark, folder):
    behind = F.when(F.col("sequence_id") % 9 == 0, F.lit(7_200_000_000)).otherwise(F.lit(0))
    return (
        events(spark, folder)
        .withColumn("batch", F.expr("sequence_id DIV 100"))
        .withColumn("rowtime", F.timestamp_micros(F.unix_micros("publish_time") - behind))
    )


@check(
    "tumble_agg",
    f"""WITH {EV}, rows AS (SELECT *, date_trunc('day', event_time) AS day FROM ev WHERE event_time IS NOT NULL AND NOT tombstone)
    SELECT day AS window_start, day + INTERVAL 1 DAY AS window_end, event_type, COUNT(*) AS events, ROUND(SUM(value), 4) AS total,
      MAX(value) AS highest FROM rows WHERE day + INTERVAL 1 DAY <= (SELECT MAX(event_time) FROM rows) GROUP BY 1, 2, 3""",
)
def tumble_agg(spark, folder):
    rows = event_rows(events(spark, folder)).select("event_time", "data.*")
    aggs = [F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("total"), F.max("value").alias("highest")]
    out = E.tumble(rows, "event_time", "1 day", aggs, by=["event_type"])
    return out.withColumn("window_start", ntz("window_start")).withColumn("window_end", ntz("window_end"))


@check(
    "assign_timestamps",
    f"""WITH {EV} SELECT event_id, CASE WHEN event_type = 'click' THEN publish_time + INTERVAL 1 SECOND ELSE event_time END AS rowtime
    FROM ev WHERE NOT tombstone""",
)
def assign_timestamps(spark, folder):
    rows = event_rows(events(spark, folder))
    chosen = F.when(F.col("data.event_type") == "click", F.col("publish_time") + F.expr("INTERVAL 1 SECOND"))
    return E.with_event_time(rows, chosen).select("data.event_id", ntz("rowtime").alias("rowtime"))


def _marks(df):
    return df.select("batch", ntz("watermark").alias("watermark"))


@check(
    "partition_watermark",
    f"WITH {ARRIVED}, {MARKS.format(rows='arrived')} SELECT batch, CASE WHEN ready = known THEN low - INTERVAL 5 MINUTE END AS watermark FROM marks",
)
def partition_watermark(spark, folder):
    return _marks(E.partition_watermark(arrived(spark, folder), "batch", "rowtime", delay_ms=300_000))


@check(
    "periodic_watermark",
    f"WITH {ARRIVED}, {MARKS.format(rows='arrived')} SELECT batch, CASE WHEN ready = known THEN low END AS watermark FROM marks",
)
def periodic_watermark(spark, folder):
    return _marks(E.partition_watermark(arrived(spark, folder), "batch", "rowtime"))


@check(
    "punctuated_watermark",
    f"""WITH {ARRIVED}, {MARKS.format(rows='(SELECT * FROM arrived WHERE event_id % 3 = 0)')}, first AS (SELECT MIN(batch) AS first FROM marks WHERE ready > 0)
    SELECT batch, CASE WHEN ready = known THEN low END AS watermark FROM marks, first WHERE batch >= first""",
)
def punctuated_watermark(spark, folder):
    return _marks(E.partition_watermark(arrived(spark, folder), "batch", "rowtime", when=F.col("sequence_id") % 3 == 0))


@check(
    "late_rows",
    f"""WITH {ARRIVED}, {MARKS.format(rows='arrived')}
    SELECT a.event_id, COALESCE(a.rowtime < m.low, FALSE) AS late FROM arrived a LEFT JOIN (SELECT * FROM marks WHERE ready = known) m ON m.batch = a.batch - 1""",
)
def late_rows(spark, folder):
    on_time, late = E.split_late(arrived(spark, folder), "batch", "rowtime")
    return on_time.select(F.col("sequence_id").alias("event_id"), F.lit(False).alias("late")).unionByName(
        late.select(F.col("sequence_id").alias("event_id"), F.lit(True).alias("late"))
    )


@check(
    "idle_source",
    f"""WITH {EV}, arrived AS (SELECT event_id // 4 AS batch, partition, publish_time AS rowtime FROM ev),
    {MARKS.format(rows='arrived')},
    act AS (SELECT r.batch, r.partition, r.high, MAX(CASE WHEN p.seen IS NOT NULL THEN r.batch END) OVER (PARTITION BY r.partition ORDER BY r.batch) AS last_batch
      FROM run r LEFT JOIN per p USING (batch, partition)),
    per_batch AS (SELECT batch, MIN(high) AS low, COUNT(*) AS ready FROM act WHERE batch - last_batch <= 2 GROUP BY 1),
    lim AS (SELECT MIN(batch) AS first, (SELECT COUNT(DISTINCT partition) FROM arrived) AS known FROM arrived)
    SELECT batch, MAX(CASE WHEN ready >= known OR batch >= first + 2 THEN low END) OVER (ORDER BY batch) AS watermark FROM per_batch, lim""",
)
def idle_source(spark, folder):
    """A partition that is silent for more than two batches, of four ids each, no longer holds the watermark."""
    m = events(spark, folder).withColumn("batch", F.expr("sequence_id DIV 4"))
    return _marks(E.partition_watermark(m, "batch", "publish_time", idle_after=2))


@check(
    "positions_summary",
    f"WITH {EV} SELECT topic, partition, MAX(event_id) // 1000 AS ledger_id, MAX(event_id) % 1000 AS entry_id, -1 AS batch_index FROM ev GROUP BY 1, 2",
)
def positions_summary(spark, folder):
    return E.positions(events(spark, folder))


@check(
    "backlog",
    f"""WITH {EV}, cur AS (SELECT partition, MAX(event_id) AS last FROM ev WHERE publish_time < {CUT} AND partition < 3 GROUP BY 1)
    SELECT topic, partition, COUNT(*) FILTER (WHERE last IS NULL OR event_id > last) AS backlog, COUNT(*) AS messages
    FROM ev LEFT JOIN cur USING (partition) GROUP BY 1, 2""",
)
def backlog(spark, folder):
    m = events(spark, folder)
    cursors = high_water(m.where(f"publish_time < {CUT} AND partition < 3")).select(*LOG, "last.*")
    return E.backlog(m, cursors)


_LINES = "numbers AS (SELECT CAST(l_orderkey % 8 AS INTEGER) AS partition, l_orderkey // 8 AS number, COUNT(*) AS copies FROM lineitem GROUP BY ALL)"


@check(
    "delivery_audit",
    f"""WITH {_LINES}, seen AS (SELECT *, number - LAG(number) OVER (PARTITION BY partition ORDER BY number) AS step FROM numbers)
    SELECT partition, CAST(SUM(copies) AS BIGINT) AS messages, COUNT(*) AS distinct_numbers, MIN(number) AS lowest, MAX(number) AS highest,
      COUNT(*) FILTER (WHERE step > 1) AS gaps, CAST(SUM(copies) AS BIGINT) - COUNT(*) AS duplicates,
      MAX(number) - MIN(number) + 1 - COUNT(*) AS missing FROM seen GROUP BY 1""",
)
def delivery_audit(spark, folder):
    """The order number should be dense inside a partition; line items repeat and skip it."""
    m = lineitem(spark, folder).withColumn("number", F.expr("sequence_id DIV 8"))
    return E.audit(m, "number").drop("topic")


@check(
    "delivery_gaps",
    f"""WITH {_LINES}, seen AS (SELECT *, LAG(number) OVER (PARTITION BY partition ORDER BY number) AS prev FROM numbers)
    SELECT partition, prev + 1 AS gap_from, number - 1 AS gap_to FROM seen WHERE number - prev > 1""",
)
def delivery_gaps(spark, folder):
    m = lineitem(spark, folder).withColumn("number", F.expr("sequence_id DIV 8"))
    return E.gap_ranges(m, "number").drop("topic")


