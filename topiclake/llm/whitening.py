"""Whitening of embeddings by their principal components, from an exact covariance.

Entries are made whole numbers first.  The covariance comes from variances alone: one sum of squared centred
values for every dimension, and one for the sum of every pair of dimensions.  Half of what the variance of
a sum has over the variances of its parts is their covariance.  All sums are exact, as whole numbers of any size:
values are centred at the whole part of the mean, so they are small, and what that leaves of the mean
is made up for in the end, exactly too.

Rows are never moved: a task adds up its batches as matrices and gives one row for each sum, which Spark adds up by
sum.  The driver gets the sums, as many as there are pairs of dimensions whatever the number of rows, and solves for the
components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from topiclake.llm.tables import let_workers_import, written

#: whole numbers for 1, and what is added to them
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: larger entries count as this
_BOUND = float(2**62)
#: sums travel as two decimals
_LIMB = 10**30


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with the sums ``sums`` of each dimension, their covariance, and its eigenvalues, falling,
    with the unit eigenvectors as columns."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    def components(self, most: int = COMPONENTS) -> int:
        """Components that have a variance, ``most`` at most."""
        if not self.n:
            return 0
        least = len(self.values) * np.finfo(float).eps * max(self.values[0], 0.0)
        return min(most, int((self.values > least).sum()))

    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)


def usable(column: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are numbers."""
    number = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(column.isNotNull() & (F.size(column) > 0) & number, F.lit(False))


def _vectors(df: DataFrame, column: str) -> DataFrame:
    vector = F.col(f"`{column}`").cast("array<double>")
    return df.withColumn("_vector", vector).where(usable(F.col("_vector")))


def dimensions(vectors: DataFrame) -> int:
    """The length that most vectors have, of equally frequent ones the largest; 0 of none."""
    sizes = vectors.groupBy(F.size("_vector").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def _whole(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as whole numbers, a column for each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).T
    return np.clip(np.floor(SCALE * flat), -_BOUND, _BOUND).astype(np.int64) + SHIFT


def _sum(values: np.ndarray) -> list[int]:
    """Exact sums of the rows of a matrix of whole numbers."""
    if values.size and int(np.abs(values).max()) * values.shape[1] >= 2**62:
        values = values.astype(object)
    return [int(v) for v in values.sum(axis=1)]


def _centred(x: np.ndarray, centre: list[int], reach: int) -> np.ndarray:
    """x less centre; as Python's whole numbers where ``reach`` squared values of a row might not fit 64 bits."""
    # neither x nor a mean is beyond 2**62 + SHIFT, so the difference of two fits
    y = x - np.array(centre, dtype=np.int64)[:, None]
    most = max(abs(int(y.max())), abs(int(y.min()))) if y.size else 0
    return y.astype(object) if most * most * reach >= 2**62 else y


def _rows(sums: list[int], n: int) -> pa.RecordBatch:
    high, low = zip(*[divmod(v, _LIMB) for v in sums]) if sums else ((), ())
    exact = pa.decimal128(38, 0)
    return pa.RecordBatch.from_pydict(
        {
            "sum_no": pa.array(range(len(sums)), pa.int64()),
            "n": pa.array([n] * len(sums), pa.int64()),
            "high": pa.array([Decimal(v) for v in high], exact),
            "low": pa.array([Decimal(v) for v in low], exact),
        }
    )


def _added(vectors: DataFrame, per_batch) -> tuple[int, list[int]]:
    """Sums over all vectors of what ``per_batch`` gives for each batch, and the number of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        n = 0
        for batch in batches:
            if len(batch):
                found = per_batch(batch.column(0))
                total = [a + b for a, b in zip(total, found)] if total else found
                n += len(batch)
        yield _rows(total, n)

    parts = vectors.select("_vector").mapInArrow(run, "sum_no bigint, n bigint, high decimal(38, 0), low decimal(38, 0)")
    sums = parts.groupBy("sum_no").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    by_no = {r["sum_no"]: int(r["high"]) * _LIMB + int(r["low"]) for r in sums}
    return (sums[0]["n"] if sums else 0), [by_no[i] for i in range(len(by_no))]


def fit(df: DataFrame, column: str = "embedding") -> Whitening:
    """Covariance and components of all usable vectors of ``df``.

    Rows whose vector is NULL, empty, or holds a NULL, NaN or infinite entry are left out, and so are vectors of another
    length than most have.  Repeated rows count each.  Entries of any size are exact up to 2**62 / 1024 and
    count as that beyond.  Of an empty table n is 0 and there are no components.  No other column is looked at.
    """
    let_workers_import(df.sparkSession)
    vectors = _vectors(df, column)
    dims = dimensions(vectors)
    if not dims:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    vectors = vectors.where(F.size("_vector") == dims)
    n, sums = _added(vectors, lambda column: _sum(_whole(column, dims)))
    centre = [s // n for s in sums]

    def squares(column: pa.Array) -> list[int]:
        y = _centred(_whole(column, dims), centre, 4 * len(column))
        found = _sum(y * y)
        for i in range(dims - 1):
            pair = y[i + 1 :] + y[i]
            found += _sum(pair * pair)
        return found

    _, found = _added(vectors, squares)
    covariance = covariance_of(n, sums, found)
    values, vectors_ = np.linalg.eigh(covariance)
    return Whitening(n, sums, covariance, values[::-1], vectors_[:, ::-1])


def covariance_of(n: int, sums: list[int], squares: list[int]) -> np.ndarray:
    """The covariance, divisor n, from sums of squares of x less the whole part of its mean: for each dimension, then for
    the sum of each pair (0, 1), (0, 2) ... (1, 2) ... of dimensions.

    With rest = sums - n * centre, n * x - sums is n * (x - centre) - rest, and the squares of that add up to
    n * n * squares - n * rest * rest.  Only the last division rounds.
    """
    dims = len(sums)
    rest = [s - n * (s // n) for s in sums]
    own = [n * n * squares[i] - n * rest[i] ** 2 for i in range(dims)]
    out, at = np.zeros((dims, dims)), dims
    for i in range(dims):
        out[i, i] = own[i] / n**3
        for j in range(i + 1, dims):
            both = n * n * squares[at] - n * (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**3)
            at += 1
    return out


def whiten(df: DataFrame, model: Whitening, column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """The usable vectors of ``df`` with ``whitened``, the projections on the first components over their standard
    deviations, and ``deviation``, the exact sum over the dimensions of (n * x - sum) squared, NULL where no long holds it.

    Other columns stay as they are; columns that have these two names are replaced.  Rows that ``fit`` leaves out, and
    vectors of another length than the model's, have no result.  Components without variance are left out, so vectors that are all equal
    have an empty ``whitened``.
    """
    let_workers_import(df.sparkSession)
    dims, n, k = len(model.sums), model.n, model.components(most)
    others = [c for c in df.columns if c not in ("deviation", "whitened")]
    centre = [s // n for s in model.sums] if n else []
    rest = np.array([s - n * c for s, c in zip(model.sums, centre)], dtype=object)
    over = model.vectors[:, :k] / np.sqrt(model.values[:k])
    part = np.array([float(r) / n for r in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            y = _centred(_whole(batch.column("_vector"), dims), centre, 1)
            most = max(abs(int(v)) for v in (y.max(), y.min()))
            wide = (n * (most + 1)) ** 2 * dims >= 2**62
            off = (y.astype(object) if wide else y) * n - (rest if wide else rest.astype(np.int64))[:, None]
            deviation = [int(d) if d < 2**63 else None for d in (off * off).sum(axis=0)]
            whitened = (y.astype(float) - part[:, None]).T @ over
            ends = np.arange(len(batch) + 1, dtype=np.int32) * k
            new = [pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(whitened.ravel(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *new], ["row", "deviation", "whitened"])

    row = F.struct(*[F.col(f"`{c}`") for c in others])
    rows = _vectors(df, column).where(F.size("_vector") == dims).select(row.alias("row"), "_vector")
    kind = rows.schema["row"].dataType.simpleString()
    done = rows.mapInArrow(run, f"row {kind}, deviation bigint, whitened array<double>")
    return done.select("row.*", "deviation", "whitened")


def identity_error(whitened: DataFrame, n: int, k: int) -> float | None:
    """The largest entry, without sign, of the covariance of ``whitened`` less the identity; None of no components."""
    if not k:
        return None
    entry = [F.get("whitened", F.lit(i)) for i in range(k)]
    means = whitened.agg(*[F.avg(e).alias(f"m{i}") for i, e in enumerate(entry)]).first()
    off = [e - F.lit(means[i]) for i, e in enumerate(entry)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = whitened.agg(*[F.sum(off[i] * off[j]).alias(f"s{at}") for at, (i, j) in enumerate(pairs)]).first()
    return max(abs(sums[at] / n - (i == j)) for at, (i, j) in enumerate(pairs))


def components(df: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Fit all vectors of ``df`` and whiten them: the rows of ``whiten`` for each component, with ``component``, ``value``,
    ``n``, ``explained`` and ``identity_error`` (one value).  The whitened rows are written once for both uses."""
    model = fit(df, column)
    k = model.components(most)
    rows = written(whiten(df, model, column, most), "whitened")
    error = identity_error(rows, model.n, k)
    shares = F.array(*[F.lit(float(v)) for v in (model.explained()[:k] if k else [])]).cast("array<double>")
    others = [c for c in rows.columns if c not in ("whitened", "component", "value", "n", "explained", "identity_error")]
    spread = rows.select(*[F.col(f"`{c}`") for c in others], F.posexplode("whitened").alias("component", "value"))
    return spread.withColumns(
        {
            "explained": F.get(shares, F.col("component")),
            "component": F.col("component") + 1,
            "n": F.lit(model.n).cast("long"),
            "identity_error": F.lit(error).cast("double"),
        }
    )
