"""Topic names: ``scheme://tenant/namespace/local`` and ``local-partition-i``."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# How a broker names the partitions of a topic.
PARTITION_SUFFIX = "-partition-"
_INDEX = r"-partition-(0|[1-9]\d*)$"


def full_name(name: str) -> str:
    """Expand a short topic name: ``x`` and ``tenant/ns/x`` are both allowed."""
    name = name.strip()
    if "://" in name:
        scheme, rest = name.split("://", 1)
        if scheme not in ("persistent", "non-persistent") or len(rest.split("/", 2)) != 3:
            raise ValueError(f"invalid topic name: {name}")
        return name
    parts = name.split("/")
    if len(parts) == 1 and parts[0]:
        return f"persistent://public/default/{name}"
    if len(parts) == 3 and all(parts):
        return f"persistent://{name}"
    raise ValueError(f"invalid topic name: {name}")


def topic_parts(topic: Column) -> Column:
    """scheme, tenant, namespace, local name without partition suffix, partition index (-1 = none)."""
    path = F.substring_index(topic, "://", -1)
    tenant = F.split_part(path, F.lit("/"), F.lit(1))
    namespace = F.split_part(path, F.lit("/"), F.lit(2))
    local = F.regexp_extract(path, r"^[^/]*/[^/]*/(.*)$", 1)
    index = F.regexp_extract(local, _INDEX, 1)
    return F.struct(
        F.split_part(topic, F.lit("://"), F.lit(1)).alias("scheme"),
        tenant.alias("tenant"),
        namespace.alias("namespace"),
        F.regexp_replace(local, _INDEX, "").alias("local_name"),
        F.when(index != "", index).otherwise(F.lit("-1")).cast("int").alias("partition_index"),
    )


def namespace_of(topic: Column) -> Column:
    """``tenant/namespace`` of a full topic name."""
    return F.substring_index(F.substring_index(topic, "://", -1), "/", 2)


def partition_topic(topic: Column, partition: Column) -> Column:
    """Name of one partition; a topic without partitions keeps its name."""
    return F.when(partition < 0, topic).otherwise(F.concat(topic, F.lit(PARTITION_SUFFIX), partition.cast("string")))


def split_partition(name: str) -> tuple[str, int]:
    """``x-partition-3`` -> (``x``, 3); any other name -> (name, -1)."""
    found = re.search(_INDEX, name)
    return (name[: found.start()], int(found.group(1))) if found else (name, -1)
