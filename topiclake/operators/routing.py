"""Which partition of a topic a message goes to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from topiclake.functions.hashing import murmur3_32

ROUTERS = ("key-hash", "round-robin")
Router = Callable[[Column, int], Column]


def route_column(
    partitions: int, router: str | Router = "round-robin", *, key: str = "key", sequence: str = "sequence_id"
) -> Column:
    """Partition number 0..partitions-1.

    ``key-hash`` keeps every key in one partition and needs a key; ``round-robin`` spreads
    by sequence number, so a repeated run routes alike; a function of (key column,
    number of partitions) is a router of the user.
    """
    if partitions < 1:
        raise ValueError("a topic needs at least one partition to route to")
    if callable(router):
        return router(F.col(key), partitions).cast("int")
    if router == "key-hash":
        hashed = F.pmod(F.abs(murmur3_32(F.col(key))), F.lit(partitions)).cast("int")
        return F.when(F.col(key).isNull(), F.raise_error(F.lit("key-hash routing needs a message key"))).otherwise(hashed)
    if router == "round-robin":
        return F.pmod(F.col(sequence), F.lit(partitions)).cast("int")
    raise ValueError(f"unknown router {router!r}; give one of {ROUTERS} or a function (key, n) -> Column")


def route(
    df: DataFrame, partitions: int, router: str | Router = "round-robin", *, key: str = "key", sequence: str = "sequence_id", mark: str | None = None
) -> DataFrame:
    """Set ``partition`` by a router.

    With ``mark`` a message that the router cannot place does not fail: that column says why, NULL for all others.
    """
    place = route_column(partitions, router, key=key, sequence=sequence)
    if mark is None:
        return df.withColumn("partition", place)
    lost = F.col(key).isNull() if router == "key-hash" else F.lit(False)
    reason = F.when(lost, F.lit("key-hash routing needs a message key"))
    return df.withColumns({"partition": F.when(~lost, place).otherwise(-1), mark: reason})
