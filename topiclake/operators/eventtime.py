"""Event time: windows, per-partition watermarks, late rows, progress of a read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from topiclake.envelope import LOG, position
from topiclake.plans.bounded import small_side
from topiclake.plans.skew import last_before
from topiclake.sources.starts import high_water


def with_event_time(m: DataFrame, expr: Column | None = None, column: str = "rowtime") -> DataFrame:
    """Event time of a row: the given expression, else the event time of the message."""
    return m.withColumn(column, F.col("event_time") if expr is None else F.coalesce(expr, F.col("event_time")))


def tumble(
    rows: DataFrame,
    ts: str,
    size: str,
    aggs: list[Column],
    by: list[str] | None = None,
    *,
    delay: str = "0 seconds",
    closed_only: bool = True,
) -> DataFrame:
    """Tumbling windows in event time: ``window_start, window_end``, groups and aggregates.

    A window is emitted once the watermark, the highest time seen minus ``delay``, has
    reached its end; rows without event time belong to no window.  On a batch
    ``closed_only=False`` emits the open windows too.
    """
    by = by or []
    source = rows.withWatermark(ts, delay) if rows.isStreaming else rows.where(F.col(ts).isNotNull())
    grouped = source.groupBy(F.window(ts, size).alias("_window"), *by).agg(*aggs)
    if closed_only and not rows.isStreaming:
        watermark = rows.agg((F.max(ts) - F.expr(f"INTERVAL {delay}")).alias("w")).scalar()
        grouped = grouped.where(F.col("_window.end") <= watermark)
    names = [c for c in grouped.columns if c not in ("_window", *by)]
    return grouped.select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *by, *names
    )


def partition_watermark(
    m: DataFrame,
    batch: str,
    ts: str,
    *,
    delay_ms: int = 0,
    when: Column | None = None,
    idle_after: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Watermark after each micro-batch: ``batch, watermark``.

    The minimum over all topic partitions of the highest time each of them has seen, so
    it never goes back; it is NULL until every partition has one.  ``when`` emits
    only at rows that meet the condition.  ``idle_after`` leaves partitions that were silent
    for that many batches out of the minimum.  ``batch`` is a dense whole number;
    ``partitions`` is how many there are, by default those seen in ``m``.

    Rows are reduced to one per batch and partition before anything is ordered.  The highest time of a
    partition never falls, so the lowest of all partitions at a batch is the lowest among the highest times that end
    after it: each change of a partition counts once, where it ends, and a running minimum over the batches does the rest.
    """
    seen_time = F.col(ts) if when is None else F.when(when, F.col(ts))
    per_batch = m.groupBy(F.col(batch).cast("bigint").alias("batch"), *LOG).agg(F.max(seen_time).alias("seen"))
    in_order = Window.partitionBy(*LOG).orderBy("batch")
    steps = (
        per_batch.withColumn("high", F.max("seen").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("next", F.lead("batch").over(in_order))
        .where(F.col("high").isNotNull())
    )
    # from the reduced rows, whose exchange the plan reuses: the input is read once
    facts = F.struct(F.min("batch").alias("first"), F.max("batch").alias("last"), F.count_distinct(*LOG).alias("logs"))
    facts = per_batch.agg(facts.alias("facts")).scalar()
    known = F.lit(partitions) if partitions is not None else facts["logs"]

    def delayed(low: Column) -> Column:
        return F.timestamp_micros(F.unix_micros(low) - delay_ms * 1000) if _is_time(m, ts) else low - delay_ms

    if idle_after is None:
        began = steps.groupBy(*LOG).agg(F.min("batch").alias("began"))
        whole = began.agg(F.min("began").alias("first"), F.max("began").alias("from"), F.count("*").alias("ready"))
        batches = whole.where("ready > 0").select("from", "ready", F.explode(F.sequence("first", facts["last"])).alias("batch"))
        ends = steps.groupBy((F.coalesce("next", facts["last"] + 1) - 1).alias("batch")).agg(F.min("high").alias("low"))
        lows = _running(batches.join(ends, "batch", "left"), "low", F.min, backwards=True)
        everyone = (F.col("ready") >= known) & (F.col("batch") >= F.col("from"))
        return lows.select("batch", F.when(everyone, delayed(F.col("low"))).alias("watermark"))
    # a partition counts for so many batches after each change at most
    until = F.least(F.coalesce(F.col("next") - 1, facts["last"]), F.col("batch") + idle_after)
    per = (
        steps.select(F.explode(F.sequence("batch", until)).alias("batch"), "high")
        .groupBy("batch")
        .agg(F.count("*").alias("ready"), F.min("high").alias("low"))
    )
    whole = (F.col("ready") >= known) | (F.col("batch") >= facts["first"] + idle_after)
    return _never_back(per.select("batch", F.when(whole, delayed(F.col("low"))).alias("watermark")))


def _never_back(marks: DataFrame, size: int = 1024) -> DataFrame:
    """The highest watermark so far, because a partition that comes back may be behind."""
    return _running(marks, "watermark", F.max, size=size)


def _running(rows: DataFrame, value: str, extreme: Callable, *, backwards: bool = False, size: int = 1024) -> DataFrame:
    """``value`` replaced by its extreme so far, in the order of ``batch`` or against it.

    Batches are ordered inside chunks; then the chunks, a thousandth as many, among themselves.
    """
    def order(column: str) -> Column:
        return F.col(column).desc() if backwards else F.col(column).asc()

    chunked = rows.withColumn("_chunk", F.expr(f"batch DIV {size}"))
    earlier = Window.orderBy(order("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    before = chunked.groupBy("_chunk").agg(extreme(value).alias("_top")).withColumn("_before", extreme("_top").over(earlier))
    inside = extreme(value).over(Window.partitionBy("_chunk").orderBy(order("batch")))
    most = F.greatest if extreme is F.max else F.least
    joined = chunked.withColumn("_inside", inside).join(before.select("_chunk", "_before"), "_chunk")
    return joined.select(*[most("_inside", "_before").alias(value) if c == value else F.col(c) for c in rows.columns])


def _is_time(m: DataFrame, ts: str) -> bool:
    return m.schema[ts].dataType.typeName() == "timestamp"


def split_late(
    m: DataFrame, batch: str, ts: str, *, delay_ms: int = 0, idle_after: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows on time, rows below the watermark that stood when their batch arrived)."""
    marks = partition_watermark(m, batch, ts, delay_ms=delay_ms, idle_after=idle_after)
    before = marks.select((F.col("batch") + 1).alias("_batch"), F.col("watermark").alias("_watermark"))
    joined = m.join(small_side(before), F.col(batch).cast("bigint") == F.col("_batch"), "left")
    late = F.coalesce(F.col(ts) < F.col("_watermark"), F.lit(False))
    return joined.where(~late).select(m.columns), joined.where(late).select(m.columns)


def positions(m: DataFrame) -> DataFrame:
    """Current position per topic partition, as columns."""
    return high_water(m).select(*LOG, "last.*")


def backlog(m: DataFrame, cursors: DataFrame) -> DataFrame:
    """Messages after the cursor per topic partition; without a cursor all of them."""
    at = cursors.select(*LOG, F.struct("ledger_id", "entry_id", "batch_index").alias("_cursor"))
    behind = F.col("_cursor").isNull() | (position() > F.col("_cursor"))
    return (
        m.join(small_side(at), LOG, "left")
        .groupBy(*LOG)
        .agg(F.count_if(behind).alias("backlog"), F.count("*").alias("messages"))
    )


def _chunks(m: DataFrame, seq: str) -> DataFrame:
    """Per 64 numbers in a row: messages, which of the numbers occur, as the bits of ``seen``, and whether the number before them
    does, as ``carry``.

    Where numbers are dense this is a row for 64 of them, at most two rows for each.  ``seen`` is NULL where only the number before
    occurs, and for messages without a number, whose ``chunk`` is NULL.
    """
    here = (
        m.select(*LOG, F.col(seq).cast("bigint").alias("number"))
        .groupBy(*LOG, F.shiftright("number", 6).alias("chunk"))
        .agg(
            F.count("*").alias("copies"),
            F.expr("bit_or(shiftleft(1L, CAST(number & 63 AS INT)))").alias("seen"),
            F.min("number").alias("first"),
            F.max("number").alias("last"),
        )
    )
    carried = "struct(chunk + 1 AS chunk, 0L AS copies, CAST(NULL AS BIGINT) AS seen, CAST(NULL AS BIGINT) AS first, CAST(NULL AS BIGINT) AS last, 1 AS carry)"
    marks = F.expr(f"""concat(array(struct(chunk, copies, seen, first, last, 0 AS carry)),
        IF(seen < 0 AND chunk < shiftright(9223372036854775807L, 6), array({carried}), array()))""")
    return (
        here.select(*LOG, F.explode(marks).alias("mark"))
        .select(*LOG, "mark.*")
        .groupBy(*LOG, "chunk")
        .agg(F.sum("copies").alias("copies"), *[F.max(c).alias(c) for c in ("seen", "first", "last", "carry")])
        # how many numbers occur after one that does not
        .withColumn("starts", F.expr("bit_count(seen & ~(shiftleft(seen, 1) | carry))"))
    )


def audit(m: DataFrame, seq: str = "sequence_id") -> DataFrame:
    """Totals, duplicates and gaps per topic partition over a number that should be dense.

    Grouped by number first, 64 at a time, so a partition of any size is spread over all tasks.
    """
    return (
        _chunks(m, seq)
        .groupBy(*LOG)
        .agg(
            F.sum("copies").alias("messages"),
            # messages without a number count as one number
            (F.coalesce(F.sum(F.bit_count("seen")), F.lit(0)) + F.max(F.col("chunk").isNull().cast("int"))).alias("distinct_numbers"),
            F.min("first").alias("lowest"),
            F.max("last").alias("highest"),
            (F.coalesce(F.sum("starts"), F.lit(0)) - 1).alias("gaps"),
        )
        .withColumn("duplicates", F.col("messages") - F.col("distinct_numbers"))
        .withColumn("missing", F.col("highest") - F.col("lowest") + 1 - F.col("distinct_numbers"))
    )


def gap_ranges(m: DataFrame, seq: str = "sequence_id") -> DataFrame:
    """The missing ranges themselves: ``gap_from, gap_to`` per topic partition."""
    chunks = _chunks(m, seq).where("chunk IS NOT NULL")
    # gaps that end in the chunk of the number before them
    places = F.expr("concat(IF(carry = 1, array(-1), array()), filter(sequence(0, 63), i -> getbit(seen, i) = 1))")
    steps = F.expr("""filter(zip_with(slice(places, 1, size(places) - 1), slice(places, 2, size(places) - 1),
        (a, b) -> struct(a + 1 AS a, b - 1 AS b)), g -> g.a <= g.b)""")
    inside = chunks.where("starts + carry > 1").withColumn("places", places).select(*LOG, "chunk", F.explode(steps).alias("gap"))
    inside = inside.select(*LOG, F.expr("chunk * 64 + gap.a").alias("gap_from"), F.expr("chunk * 64 + gap.b").alias("gap_to"))
    # the others: a number that begins a gap, and the next that ends it, in a later chunk
    ends = F.expr("""concat(IF(seen IS NULL, array(struct(chunk * 64 AS number, chunk * 64 AS begin)), array()),
        IF(seen IS NOT NULL AND carry = 0, array(struct(first AS number, CAST(NULL AS BIGINT) AS begin)), array()),
        IF(seen >= 0, array(struct(last + 1 AS number, last + 1 AS begin)), array()))""")
    edges = chunks.select(*LOG, F.explode(ends).alias("edge")).select(*LOG, "edge.*")
    paired = last_before(edges, LOG, ["number"], "begin", "gap_from")
    across = paired.where(F.col("begin").isNull() & F.col("gap_from").isNotNull()).select(*LOG, "gap_from", (F.col("number") - 1).alias("gap_to"))
    return inside.unionByName(across)
