"""Look-behind within a key that survives hot keys.

A window partitioned by key puts every row of a key into one task, so a key that
holds a third of a log would stop the job.  ``last_before`` keeps the plain window for
ordinary keys.  Rows of hot keys are sorted over all tasks by key and order, whatever the
types and with NULLs first as in any sort; a task's part of a key is a slice.  What a slice
needs from the slices before it is one value, found by a small aggregate and added to
the slice as one extra row.  The result does not depend on which keys count as hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from topiclake.plans.bounded import small_rows
from topiclake.plans.workspace import new_dir

#: rows of one key that a single task may sort; override with this session setting
ROWS_PER_TASK_KEY = "spark.topiclake.rowsPerTask"
ROWS_PER_TASK = 2_000_000
#: sampled rows by which a key of that size is found
SAMPLED = 1000


def rows_per_task(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_TASK_KEY, str(ROWS_PER_TASK)))


def hot_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash of key and estimated rows, for keys with more rows than one task should sort.

    Counts a sample of the key column in which a hot key has about SAMPLED rows, so next
    to nothing is shuffled.  The sample decides about speed, never about results.  A key that
    shares its hash with a hot one is sliced too, which is harmless.
    """
    limit = rows_per_task(df)
    share = min(1.0, SAMPLED / max(limit, 1))
    hashes = df.select(F.xxhash64(*keys).alias("_hash"))
    some = hashes if share == 1.0 else hashes.sample(share, seed=1)
    return some.groupBy("_hash").agg((F.count("*") / share).alias("_rows")).where(F.col("_rows") > limit)


def add_slices(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame] | None:
    """The rows of ordinary keys, and those of hot keys with ``_slice``: which part of the
    order of its key a row is in.  None when there are no hot keys.

    The sliced rows are written, because ranges must not move between two uses.  A limit of
    0 rows says that there are no hot keys and skips the look at them.
    """
    spark = df.sparkSession
    if rows_per_task(df) == 0:
        return None
    hot = hot_keys(df, keys)
    few = small_rows(hot)
    if few == []:
        return None
    if few is None:
        # the sampled rows hold so many hot keys that they are not fetched
        path = new_dir(spark, "hot-keys")
        hot.write.parquet(path)
        hot = spark.read.schema("_hash BIGINT, _rows DOUBLE").parquet(path)
        total, side = hot.agg(F.sum("_rows")).first()[0], hot.select("_hash")
    else:
        total = sum(r["_rows"] for r in few)
        side = F.broadcast(spark.createDataFrame([(r["_hash"],) for r in few], "_hash BIGINT"))
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    ranges = max(2, -(-2 * int(total) // rows_per_task(df)))
    sliced = hashed.join(side, "_hash", "left_semi").drop("_hash").repartitionByRange(ranges, *keys, *order)
    path = new_dir(spark, "slices")
    sliced.withColumn("_slice", F.spark_partition_id()).write.parquet(path)
    return hashed.join(side, "_hash", "left_anti").drop("_hash"), spark.read.parquet(path)


def last_before(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str, *, backwards: bool = False
) -> DataFrame:
    """Add ``name``: the latest non-NULL ``value`` among the earlier rows of the same key.

    ``value`` is a column, so that it is shuffled once.  ``order`` may be of any types that sort;
    NULL comes before all others.  With ``backwards`` it is the next value instead of the last.
    """
    sort = [F.col(c).desc() if backwards else F.col(c).asc() for c in order]
    before = (Window.unboundedPreceding, -1)

    def looked_back(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(*before)
        return rows.withColumn(name, F.last(value, ignorenulls=True).over(window))

    parts = add_slices(df, keys, order)
    if parts is None:
        return looked_back(df)
    cold, sliced = parts
    pick = F.min_by if backwards else F.max_by
    present = F.when(F.col(value).isNotNull(), F.struct(*order))
    # one row per hot key and slice: the last value of the slice, then that of the slices before it
    ends = sliced.groupBy(*keys, "_slice").agg(pick(F.col(value), present).alias(value))
    slices = F.col("_slice").desc() if backwards else F.col("_slice").asc()
    by_slice = Window.partitionBy(*keys).orderBy(slices).rowsBetween(*before)
    carried = (
        ends.withColumn(value, F.last(value, ignorenulls=True).over(by_slice))
        .where(F.col(value).isNotNull())
        .withColumn("_carried", F.lit(True))
    )
    window = Window.partitionBy(*keys, "_slice").orderBy(F.col("_carried").desc(), *sort).rowsBetween(*before)
    warm = (
        sliced.withColumn("_carried", F.lit(False))
        .unionByName(carried, allowMissingColumns=True)
        .withColumn(name, F.last(value, ignorenulls=True).over(window))
        .where(~F.col("_carried"))
        .drop("_slice", "_carried")
    )
    return looked_back(cold).unionByName(warm)
