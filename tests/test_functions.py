from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from topiclake.functions import times
from topiclake.functions.hashing import java_hash, key_slot, murmur3_32
from topiclake.functions.positions import parse_positions, pos_cmp, pos_next, pos_prev, position_text
from topiclake.functions.topic_names import full_name, split_partition


def plain_murmur(data: bytes) -> int:
    mask, h, whole = 0xFFFFFFFF, 0, len(data) // 4 * 4

    def mix(k):
        k = k * 0xCC9E2D51 & mask
        return ((k << 15 | k >> 17) & mask) * 0x1B873593 & mask

    for i in range(0, whole, 4):
        h ^= mix(int.from_bytes(data[i : i + 4], "little"))
        h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    if data[whole:]:
        h ^= mix(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_murmur_known_values(spark):
    known = {"": 0, "hello": 0x248BFA47, "hello, world": 0x149BBB7F}
    df = spark.createDataFrame([(k,) for k in known], "s STRING").select("s", murmur3_32(F.col("s")).alias("h"))
    assert {r.s: r.h & 0xFFFFFFFF for r in df.collect()} == known


def test_murmur_any_bytes(spark):
    rng = random.Random(7)
    data = [bytes(rng.randrange(256) for _ in range(n)) for n in range(34) for _ in range(30)]
    df = spark.createDataFrame([(bytearray(d),) for d in data], "b BINARY")
    got = df.select("b", murmur3_32(F.col("b")).alias("h"), key_slot(F.col("b")).alias("slot")).collect()
    assert all(r.h == plain_murmur(bytes(r.b)) and r.slot == r.h & 0xFFFF for r in got)
    assert df.select(murmur3_32(F.lit(None).cast("binary")).alias("h")).first().h is None


def test_java_hash(spark):
    def plain(text):
        h = 0
        raw = text.encode("utf-16-be")
        for i in range(0, len(raw), 2):
            h = (h * 31 + int.from_bytes(raw[i : i + 2], "big")) & 0xFFFFFFFF
        return h - (1 << 32) if h >> 31 else h

    texts = ["", "a", "persistent://public/default/x-partition-0", "grüße", "日本", "😀 emoji"]
    got = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", java_hash(F.col("t")).alias("h"))
    assert {r.t: r.h for r in got.collect()} == {t: plain(t) for t in texts}


def _pos(ledger, entry, batch):
    return F.struct(
        F.lit(ledger).cast("bigint").alias("ledger_id"), F.lit(entry).cast("bigint").alias("entry_id"), F.lit(batch).alias("batch_index")
    )


@pytest.mark.parametrize(
    "a, b, want",
    [
        ((1, 5, -1), (1, 5, 3), 0),
        ((1, 5, 2), (1, 5, 3), -1),
        ((1, 6, -1), (1, 5, 3), 1),
        ((1, 9, 9), (2, 0, -1), -1),
        ((3, 3, 3), (3, 3, 3), 0),
    ],
)
def test_pos_cmp(spark, a, b, want):
    assert spark.range(1).select(pos_cmp(_pos(*a), _pos(*b)).alias("c")).first().c == want


def test_neighbours(spark):
    df = spark.range(1).select(
        pos_next(_pos(4, 7, 3)).alias("n"), pos_prev(_pos(4, 7, 3)).alias("p"), pos_next(_pos(4, 7, -1)).alias("n1"),
        pos_prev(_pos(4, 7, -1)).alias("p1"), position_text(_pos(4, 7, 3), F.lit(2)).alias("t"),
    )
    row = df.first()
    assert (tuple(row.n), tuple(row.p)) == ((4, 8, -1), (4, 7, 2))
    assert (tuple(row.n1), tuple(row.p1)) == ((4, 8, -1), (4, 6, -1))
    assert row.t == "4:7:2"


def test_parse_positions(spark):
    got = parse_positions(spark, "42:1012:0;44:1011:1")
    assert sorted(map(tuple, got.collect())) == [(0, 42, 1012), (1, 44, 1011)]
    # an empty element ends the list
    assert parse_positions(spark, "1:2:3;;4:5:6").count() == 1


@pytest.mark.parametrize("text", ["42:1012", "1:2:3,4:5:6", "a:2:3", "1:2:x", "", "1:2:3:4"])
def test_parse_positions_refuses(spark, text):
    with pytest.raises(ValueError):
        parse_positions(spark, text)


def test_topic_names():
    assert full_name("x") == "persistent://public/default/x"
    assert full_name(" a/b/c ") == "persistent://a/b/c"
    assert full_name("non-persistent://a/b/c") == "non-persistent://a/b/c"
    for bad in ("a/b", "", "x://a/b/c", "persistent://a/b"):
        with pytest.raises(ValueError):
            full_name(bad)
    assert split_partition("x-partition-3") == ("x", 3)
    assert split_partition("x-partition-03") == ("x-partition-03", -1)


def test_string_to_time(spark):
    texts = {
        "2020-02-03": dt.datetime(2020, 2, 3),
        "2020-02-03 04:05:06.25": dt.datetime(2020, 2, 3, 4, 5, 6, 250000),
        "2000-01-01T00:00GMT+01:00": dt.datetime(2000, 1, 1),
        "2020-02-03T04:05:06Z": dt.datetime(2020, 2, 3, 4, 5, 6),
        "2020-02-03T04:05:06-08:00": dt.datetime(2020, 2, 3, 4, 5, 6),
    }
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = df.select("t", times.string_to_time(F.col("t")).alias("x")).collect()
    assert {r.t: r.x for r in got} == texts


def test_times_before_the_epoch(spark):
    row = spark.range(1).select(
        times.micros_to_ts(F.lit(-1).cast("bigint")).alias("ts"),
        times.millis_to_days(F.lit(-1).cast("bigint")).alias("day"),
        times.ts_to_micros(F.lit(None).cast("timestamp")).alias("unset"),
        times.ts_to_string(F.timestamp_micros(F.lit(1_500_000))).alias("fraction"),
        times.ts_to_string(F.timestamp_micros(F.lit(1_000_000))).alias("whole"),
    ).first()
    assert row.ts == dt.datetime(1969, 12, 31, 23, 59, 59, 999999)
    assert (row.day, row.unset) == (-1, 0)
    assert (row.fraction, row.whole) == ("1970-01-01 00:00:01.5", "1970-01-01 00:00:01")
