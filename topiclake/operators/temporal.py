"""Joins with a versioned table as of event time."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window, functions as F

from topiclake.plans.bounded import small_rows
from topiclake.plans.skew import last_before

#: versions that are broadcast instead of shuffling the left side, and how many one key may have
BROADCAST_VERSIONS = 20_000
VERSIONS_PER_KEY = 256
BROADCAST_BYTES = 32 * 1024 * 1024


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    how: str = "left",
    *,
    right_order: list[str] | None = None,
    deleted: str | None = None,
    broadcast_versions: int = BROADCAST_VERSIONS,
) -> DataFrame:
    """For each left row, the right version with the greatest time not after the left time.

    ``right_order`` decides between versions of one key at the same time.  ``deleted``
    names a boolean column of versions that end the row: left rows after them match
    nothing.  ``left`` keeps unmatched rows with NULLs, ``inner`` drops them.

    A right side of at most ``broadcast_versions`` rows, with few versions per key, is
    broadcast as validity intervals, and the left side is not shuffled.  Otherwise both
    sides go through one shuffle as one stream of rows, in which each left row looks back
    to the last version; no pairs are built, and hot keys are cut into slices.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    right_order = right_order or []
    right_columns = [c for c in right.columns if c not in on]
    clash = set(right_columns) & set(left.columns)
    if clash:
        raise ValueError(f"rename the columns both sides have: {sorted(clash)}")
    found = right.dropna(subset=[*on, right_ts])
    if _few_versions(found, on, broadcast_versions):
        return _broadcast_join(left, found, on, left_ts, right_ts, how, right_order, deleted)
    keys = [f"_k{i}" for i in range(len(on))]
    ties = [f"_o{i}" for i in range(len(right_order))]

    # a row without time or key can match nothing: versions are dropped, left rows kept
    versions = found.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        F.col(right_ts).alias("_ts"),
        F.lit(0).alias("_side"),
        *[F.col(c).alias(o) for c, o in zip(right_order, ties)],
        F.struct(*right_columns).alias("_right"),
    )
    # left rows without time come before all versions; those with time are told apart from versions by the side,
    # so they need no ties.  NULL is of any type
    rows = left.select(
        *[F.col(c).alias(k) for c, k in zip(on, keys)],
        F.col(left_ts).alias("_ts"),
        F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_left"),
    )
    both = versions.unionByName(rows, allowMissingColumns=True).withColumn("_timed", F.col("_ts").isNotNull())
    seen = last_before(both, keys, ["_timed", "_ts", "_side", *ties], "_right", "_match").where("_side = 1")
    return _with_match(seen, [F.col("_left.*")], right_columns, how, deleted)


def _with_match(
    rows: DataFrame, left: list[Column], right_columns: list[str], how: str, deleted: str | None
) -> DataFrame:
    """Left columns and those of the version in ``_match``; a delete version matches nothing."""
    matched = F.col("_match").isNotNull()
    if deleted is not None:
        matched = matched & ~F.coalesce(F.col(f"_match.`{deleted}`"), F.lit(False))
    if how == "inner":
        rows = rows.where(matched)
    out = [c for c in right_columns if c != deleted]
    return rows.select(*left, *[F.when(matched, F.col(f"_match.`{c}`")).alias(c) for c in out])


def _few_versions(right: DataFrame, on: list[str], limit: int) -> bool:
    """Whether the versions are few and small enough to broadcast; fetches only their keys and sizes."""
    if limit <= 0:
        return False
    size = F.octet_length(F.struct(*right.columns).cast("string"))
    rows = small_rows(right.select(size.alias("_size"), *on), limit)
    if rows is None or sum(row["_size"] for row in rows) > BROADCAST_BYTES:
        return False
    return max(Counter(tuple(row)[1:] for row in rows).values(), default=0) <= VERSIONS_PER_KEY


def _broadcast_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_ts: str,
    right_ts: str,
    how: str,
    right_order: list[str],
    deleted: str | None,
) -> DataFrame:
    """The same join with the versions as intervals, of which at most one holds a left row."""
    right_columns = [c for c in right.columns if c not in on]
    in_order = Window.partitionBy(*on).orderBy(right_ts, *right_order)
    versions = right.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(on)],
        F.col(right_ts).alias("_from"),
        F.lead(right_ts).over(in_order).alias("_to"),
        F.struct(*right_columns).alias("_match"),
    )
    holds = (F.col(left_ts) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(left_ts) < F.col("_to")))
    for i, c in enumerate(on):
        holds = holds & (left[c] == F.col(f"_k{i}"))
    joined = left.join(F.broadcast(versions), holds, "left")
    return _with_match(joined, [F.col(c) for c in left.columns], right_columns, how, deleted)


def intervals(changes: DataFrame, pk: list[str], ts: str, order: list[str] | None = None) -> DataFrame:
    """Versions with their validity ``[valid_from, valid_to)``; NULL means still valid.

    ``order`` decides between changes of one key at the same time, of which only the
    last is ever valid.  Deletes end a version and have none of their own.
    """
    step = [ts, *(order or [])]
    ended = last_before(changes, pk, step, ts, "valid_to", backwards=True)
    return ended.where(
        (F.col("row_kind").isin("+I", "+U")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col(ts)))
    ).withColumn("valid_from", F.col(ts))
