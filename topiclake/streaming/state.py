"""Rows kept between micro-batches, as parquet tables in the shared folder.

Micro-batches are numbered without holes, so every path follows from the number of the
batch.  A batch reads only what earlier batches wrote and writes only what no earlier
batch needs, so it can run again after a failure.  Old tables are overwritten in turn.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from topiclake.plans.commits import found, recorded, removed


class BatchState:
    """A table that grows by the rows of each batch.

    Each batch writes its own rows; after ``every`` batches they are merged into a base.
    ``merge`` reduces rows of several batches, for instance to the last one per key.
    """

    def __init__(self, path: str, merge: Callable[[DataFrame], DataFrame], every: int = 20) -> None:
        self.path, self.merge, self.every = path.rstrip("/"), merge, every

    def _base(self, epoch: int) -> str:
        return f"{self.path}/base={epoch % 2}"

    def _rows(self, batch_id: int) -> str:
        return f"{self.path}/rows={batch_id % (2 * self.every)}"

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """What the batches before this one left; None before the first."""
        epoch = batch_id // self.every
        paths = [self._base(epoch)] if epoch else []
        paths += [self._rows(i) for i in range(epoch * self.every, batch_id)]
        return self.merge(spark.read.parquet(*paths)) if paths else None

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Keep the rows of this batch."""
        rows.write.mode("overwrite").parquet(self._rows(batch_id))
        if (batch_id + 1) % self.every == 0:
            first = batch_id + 1 - self.every
            paths = [self._base(first // self.every)] if first else []
            paths += [self._rows(i) for i in range(first, batch_id + 1)]
            merged = self.merge(rows.sparkSession.read.parquet(*paths))
            merged.write.mode("overwrite").parquet(self._base(first // self.every + 1))


class WholeState:
    """A table that each batch replaces."""

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """What the batch before this one left; None before the first."""
        return spark.read.parquet(f"{self.path}/state={batch_id % 2}") if batch_id else None

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Keep ``rows`` instead."""
        rows.write.mode("overwrite").parquet(f"{self.path}/state={(batch_id + 1) % 2}")


#: buckets of a keyed state, unless given
BUCKETS = 256


class KeyedState:
    """Rows by key, of which a batch reads only the buckets that its own keys fall in.

    A batch writes its rows by the hash of their key.  After ``every`` batches the buckets that these have touched
    are merged each into a base of its own; buckets that no batch touched stay where they are, in an older base, and a
    base that a newer one has replaced is removed an epoch later, when no batch that runs again can need it.
    The number of buckets is recorded with the state and never changes.
    """

    def __init__(self, path: str, keys: list[str], merge: Callable[[DataFrame], DataFrame], every: int = 20, buckets: int = BUCKETS) -> None:
        self.path, self.keys, self.merge, self.every, self.wanted = path.rstrip("/"), keys, merge, every, buckets

    def buckets(self, spark: SparkSession) -> int:
        place = f"{self.path}/buckets"
        return int(recorded(spark, place) or recorded(spark, place, str(self.wanted)))

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets(rows.sparkSession))).cast("int"))

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the keys of ``rows``; as many numbers as there are buckets come to the driver at most."""
        return sorted(r["_bucket"] for r in self._bucketed(rows).select("_bucket").distinct().collect())

    def _folders(self, spark: SparkSession, pattern: str, buckets: list[int] | None = None) -> list[tuple[int, int]]:
        """(number, bucket) of the folders ``<name>=<number>/_bucket=<bucket>``."""
        asked = "*" if buckets is None or len(buckets) > 64 else f"{{{','.join(map(str, buckets))}}}"
        places = [p.split("/")[-2:] for p in found(spark, f"{self.path}/{pattern}/_bucket={asked}")]
        return sorted((int(n.partition("=")[2]), int(b.partition("=")[2])) for n, b in places)

    def _read(self, spark: SparkSession, schema, epoch: int, batches: range, buckets: list[int] | None) -> DataFrame | None:
        """Rows of the newest base up to ``epoch`` of each bucket and of the batches since."""
        asked = None if buckets is None else set(buckets)
        newest = {b: e for e, b in self._folders(spark, "base=*", buckets) if e <= epoch}
        paths = [f"base={e}/_bucket={b}" for b, e in newest.items() if asked is None or b in asked]
        slots = {i % (2 * self.every) for i in batches}
        paths += [f"rows={i}/_bucket={b}" for i, b in self._folders(spark, "rows=*", buckets) if i in slots and (asked is None or b in asked)]
        if not paths:
            return None
        return spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in paths])

    def before(self, spark: SparkSession, schema, batch_id: int, buckets: list[int] | None = None) -> DataFrame | None:
        """What the batches before this one left in ``buckets``, all unless given; None if there is nothing."""
        if buckets == []:
            return None
        epoch = batch_id // self.every
        rows = self._read(spark, schema, epoch, range(epoch * self.every, batch_id), buckets)
        return None if rows is None else self.merge(rows)

    def _write(self, rows: DataFrame, place: str) -> None:
        # a bucket is one file, or more where it is large
        self._bucketed(rows).hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/{place}")

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Keep the rows of this batch."""
        spark, schema = rows.sparkSession, rows.schema
        self._write(rows, f"rows={batch_id % (2 * self.every)}")
        if (batch_id + 1) % self.every:
            return
        epoch = batch_id // self.every
        batches = range(epoch * self.every, batch_id + 1)
        slots = {i % (2 * self.every) for i in batches}
        touched = sorted({b for i, b in self._folders(spark, "rows=*") if i in slots})
        merged = self._read(spark, schema, epoch, batches, touched)
        if merged is not None:
            self._write(self.merge(merged), f"base={epoch + 1}")
        self._forget(spark, epoch)

    def _forget(self, spark: SparkSession, epoch: int) -> None:
        newest: dict[int, int] = {}
        for e, b in self._folders(spark, "base=*"):
            if e <= epoch:
                if b in newest:
                    removed(spark, f"{self.path}/base={newest[b]}/_bucket={b}")
                newest[b] = e
