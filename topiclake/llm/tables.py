"""What the operators of this subpackage share: input columns, tables between jobs, workers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topiclake.plans.commits import removed
from topiclake.plans.workspace import new_dir


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package also where it is only on the driver's path.

    On a cluster the package comes with the job (``--py-files`` or an environment); the
    entry added here then names a folder that the workers do not have, which is harmless.
    """
    here = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])


#: Spark removes the shuffle files of a job when it ends, and does not wait for the driver to collect garbage
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: the folder of the innermost ``scratch``
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def _stored(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it is computed once, and a lost
    executor takes nothing with it.  Inside a ``scratch`` the table goes when that ends."""
    path = new_dir(df.sparkSession, purpose)
    folder = _SCRATCH.get()
    return _stored(df, path if folder is None else f"{folder}/{path.rpartition('/')[2]}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that are ``written`` inside are removed at the end; the function that is given writes what stays,
    which is what ``written`` writes outside, or in the ``scratch`` around."""
    outer, folder = _SCRATCH.get(), new_dir(spark, "scratch")

    def kept(df: DataFrame, purpose: str) -> DataFrame:
        token = _SCRATCH.set(outer)
        try:
            return written(df, purpose)
        finally:
            _SCRATCH.reset(token)

    token = _SCRATCH.set(folder)
    try:
        yield kept
    finally:
        _SCRATCH.reset(token)
        removed(spark, folder)


#: rows of a few fixed-width columns that are broadcast, about 64 MB
BROADCAST_ROWS = 1_000_000


def counted_side(keys: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow keys, marked for broadcast when it has no more than ``limit`` rows;
    beyond that the join is shuffled."""
    return F.broadcast(keys) if keys.count() <= limit else keys


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def row_key() -> Column:
    """Rows of (doc_id, text) that are equal have the same key; a NULL text is like an empty one."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))


def as_row(docs: DataFrame, *without: str) -> Column:
    """All columns as one, out of the way of the names an operator uses."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without])


def with_text(rows: DataFrame, columns: list[str], text: Column, changed: Column) -> DataFrame:
    """Take apart the column ``row`` of ``as_row``; text is new, and n_chars follows where it changed."""
    own = F.col("row")
    new = {"text": text}
    if "n_chars" in columns:
        new["n_chars"] = F.when(changed, F.length(text).cast("long")).otherwise(own["n_chars"].cast("long"))
    return rows.select(*[new.get(c, own[c]).alias(c) for c in columns])
