from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from helpers import at, messages, rows
from topiclake.operators import changelog as C
from topiclake.operators.temporal import as_of_join, intervals
from topiclake.plans.skew import add_slices, last_before

def key():
    return {"id": F.col("key").cast("string")}



def upserts(spark, *steps):
    """(key, value or None) in order."""
    data = [(0, i, k, None if v is None else f'{{"v": {v}}}' if v != "" else "", i) for i, (k, v) in enumerate(steps)]
    return C.decode_upsert(messages(spark, data), key(), "v INT")


def kinds(df):
    return [tuple(r) for r in df.orderBy("entry_id", "step").select("row_kind", "id", "v").collect()]


def test_normalize_rules(spark):
    changes = upserts(spark, ("a", 1), ("a", 2), ("b", 5), ("a", 2), ("a", None), ("a", None), ("c", None), ("a", 3), ("b", ""))
    assert kinds(C.normalize(changes, ["id"], columns=["v"])) == [
        ("+I", "a", 1),
        ("-U", "a", 1),
        ("+U", "a", 2),
        ("+I", "b", 5),
        # the same row again, and deletes of unknown keys, change nothing
        ("-D", "a", 2),
        ("+I", "a", 3),
        ("-D", "b", 5),
    ]


def plain_normalize(steps):
    """The rules, one message at a time."""
    table, out = {}, []
    for i, (key, value) in enumerate(steps):
        old = table.get(key)
        if value is None:
            if old is not None:
                out.append((i, 0, "-D", key, old))
            table.pop(key, None)
        elif old is None:
            out.append((i, 0, "+I", key, value))
            table[key] = value
        elif old != value:
            out += [(i, 0, "-U", key, old), (i, 1, "+U", key, value)]
            table[key] = value
    return sorted(out), table


@pytest.mark.parametrize("limit", [8, 10**9])
@pytest.mark.parametrize("seed", [1, 2])
def test_normalize_any_sequence(spark, seed, limit):
    rng = random.Random(seed)
    # one key holds half of the messages
    steps = [("h" if rng.random() < 0.5 else rng.choice("abcdef"), rng.choice([None, 1, 2, 3])) for _ in range(500)]
    want, table = plain_normalize(steps)
    changes = upserts(spark, *steps)
    spark.conf.set("spark.topiclake.rowsPerTask", str(limit))
    try:
        got = rows(C.normalize(changes, ["id"], columns=["v"]), "entry_id", "step", "row_kind", "id", "v")
    finally:
        spark.conf.unset("spark.topiclake.rowsPerTask")
    assert got == want
    assert dict(rows(C.latest(changes, ["id"]), "id", "v")) == table


@pytest.mark.parametrize("limit", [10, 10**9])
def test_as_of_any_times(spark, limit):
    rng = random.Random(11)
    users = ["hot"] * 6 + list("abcdef")
    left = [(i, rng.choice(users), rng.randrange(1000)) for i in range(600)]
    right = sorted({(rng.choice(users), rng.randrange(1000)) for _ in range(300)})
    versions = {}
    for n, (user, since) in enumerate(right):
        versions.setdefault(user, []).append((since, n, rng.random() < 0.2))

    def match(user, t):
        found = [v for v in versions.get(user, []) if v[0] <= t]
        return None if not found or max(found)[2] else max(found)[1]

    left_df = spark.createDataFrame([(i, u, at(t)) for i, u, t in left], "view INT, user STRING, viewed TIMESTAMP")
    flat = [(u, at(since), n, gone) for u, vs in versions.items() for since, n, gone in vs]
    right_df = spark.createDataFrame(flat, "user STRING, since TIMESTAMP, version INT, gone BOOLEAN")
    want = [(i, match(u, t)) for i, u, t in left]
    spark.conf.set("spark.topiclake.rowsPerTask", str(limit))
    try:
        for few in (0, 1000):
            joined = as_of_join(left_df, right_df, ["user"], "viewed", "since", deleted="gone", broadcast_versions=few)
            assert rows(joined, "view", "version") == want
    finally:
        spark.conf.unset("spark.topiclake.rowsPerTask")


def test_latest_and_as_of(spark):
    changes = upserts(spark, ("a", 1), ("b", 5), ("a", None), ("c", 7), ("c", 8))
    assert rows(C.latest(changes, ["id"]), "id", "v") == [("b", 5), ("c", 8)]
    assert rows(C.latest_as_of(changes, ["id"], F.col("entry_id") <= 1), "id", "v") == [("a", 1), ("b", 5)]


def test_latest_table_equals_latest(spark):
    data = [(0, i, f"k{i % 7}", None if i % 5 == 0 else f'{{"v": {i}}}', i) for i in range(60)]
    m = messages(spark, data)
    want = rows(C.latest(C.decode_upsert(m, key(), "v INT"), ["id"]), "id", "v")
    assert rows(C.latest_table(m, key(), "v INT"), "id", "v") == want
    assert C.compact(m).count() == len(want)


def test_normalize_then_encode_gives_the_same_table(spark):
    rng = random.Random(3)
    steps = [(rng.choice("abcd"), rng.choice([None, 1, 2, 3])) for _ in range(80)]
    changes = upserts(spark, *steps)
    full = C.normalize(changes, ["id"], columns=["v"])
    order = ["ledger_id", "entry_id", "step"]
    back = C.encode_upsert(full, ["id"], ["v"], keep=order).withColumn("key", F.get_json_object(F.col("key").cast("string"), "$.id"))
    again = C.decode_upsert(back, {"id": F.col("key")}, "v INT", keep=order)
    assert rows(C.latest(again, ["id"], order), "id", "v") == rows(C.latest(changes, ["id"]), "id", "v")


def test_count_change(spark):
    full = C.normalize(upserts(spark, ("a", 1), ("b", 1), ("a", 2), ("c", 2), ("b", None)), ["id"], columns=["v"])
    assert rows(C.count_change(full, ["v"]), "v", "count") == [(2, 2)]


def test_upsert_needs_a_key(spark):
    with pytest.raises(ValueError):
        C.decode_upsert(messages(spark, [(0, 0, "a", "{}", 0)]), {}, "v INT")


# look-behind with hot keys ------------------------------------------------------------


def skewed(spark, n=3000):
    """One key holds a third of the rows, and all of its times lie in one hour of a year."""
    rng = random.Random(5)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(400)}"
        second = rng.randrange(3600) if key == "hot" else rng.randrange(365 * 86400)
        data.append((key, at(second), i, rng.choice([None, None, i])))
    return spark.createDataFrame(data, "k STRING, t TIMESTAMP, i INT, v INT")


@pytest.mark.parametrize("backwards", [False, True])
@pytest.mark.parametrize("limit", [7, 100, 10**9])
def test_last_before_is_the_same_with_slices(spark, backwards, limit):
    df = skewed(spark)
    sort = [F.col("t").desc(), F.col("i").desc()] if backwards else ["t", "i"]
    window = Window.partitionBy("k").orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    want = rows(df.withColumn("p", F.last("v", ignorenulls=True).over(window)), "k", "i", "p")
    spark.conf.set("spark.topiclake.rowsPerTask", str(limit))
    try:
        assert rows(last_before(df, ["k"], ["t", "i"], "v", "p", backwards=backwards), "k", "i", "p") == want
    finally:
        spark.conf.unset("spark.topiclake.rowsPerTask")


@pytest.fixture
def slices_of_50(spark):
    spark.conf.set("spark.topiclake.rowsPerTask", "50")
    yield
    spark.conf.unset("spark.topiclake.rowsPerTask")


@pytest.mark.parametrize("order", [["t", "i"], ["ledger", "far", "i"], ["name", "share", "i"]])
def test_slices_are_bounded_and_in_order(spark, slices_of_50, order):
    """Also when the first column is constant, NULL in places, text, or a double."""
    df = skewed(spark).withColumn("ledger", F.lit(4).cast("bigint")).withColumn("far", F.col("i").cast("bigint") * F.lit(10**12))
    df = df.withColumn("name", F.when(F.col("i") % 7 > 0, F.lpad(F.col("i").cast("string"), 9, "0"))).withColumn("share", F.col("i") / 7)
    cold, sliced = add_slices(df, ["k"], order)
    assert {r.k for r in sliced.select("k").distinct().collect()} == {"hot"}
    assert cold.where("k = 'hot'").count() == 0 and cold.count() == 2000
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 60
    along = [r._slice for r in sliced.orderBy(*order).select("_slice").collect()]
    assert along == sorted(along)


@pytest.mark.parametrize("backwards", [False, True])
@pytest.mark.parametrize("order", [["name", "i"], ["t", "name", "i"], ["share", "i"], ["money", "i"]])
def test_nulls_and_all_types_in_the_order(spark, slices_of_50, order, backwards):
    df = skewed(spark).withColumn("name", F.when(F.col("i") % 7 > 0, F.col("i").cast("string"))).withColumn("share", F.col("i") / 7)
    df = df.withColumn("t", F.when(F.col("i") % 5 > 0, F.col("t"))).withColumn("money", (F.col("i") % 11).cast("decimal(38, 2)"))
    sort = [F.col(c).desc() if backwards else F.col(c) for c in order]
    window = Window.partitionBy("k").orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    want = rows(df.withColumn("p", F.last("v", ignorenulls=True).over(window)), "k", "i", "p")
    assert rows(last_before(df, ["k"], order, "v", "p", backwards=backwards), "k", "i", "p") == want


def test_normalize_without_publish_times(spark, hot):
    """The same changes with and without slices when part of the order is NULL."""
    df = spark.range(40).select(
        F.when(F.col("id") % 5 == 3, "-D").otherwise("+U").alias("row_kind"), F.lit("a").alias("k"), (F.col("id") / 2).cast("int").alias("v"),
        F.create_map(F.lit("x"), (F.col("id") / 4).cast("int"), F.lit("y"), F.lit(1)).alias("m"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("p"), F.col("id").alias("o"),
    )
    got = rows(C.normalize(df, ["k"], ["o", "p"]), "o", "step", "row_kind", "v")
    spark.conf.set("spark.topiclake.rowsPerTask", "1000")
    assert got == rows(C.normalize(df, ["k"], ["o", "p"]), "o", "step", "row_kind", "v")


def test_equal_maps_are_no_change(spark):
    df = spark.sql("SELECT * FROM VALUES ('+U', 'a', 1, map('x', 1, 'y', 2)), ('+U', 'a', 2, map('y', 2, 'x', 1)), ('+U', 'a', 3, map('x', 2)) AS t(row_kind, id, n, m)")
    assert rows(C.normalize(df, ["id"], ["n"]), "n", "row_kind") == [(1, "+I"), (3, "+U"), (3, "-U")]


def test_the_count_can_be_skipped(spark):
    spark.conf.set("spark.topiclake.rowsPerTask", "0")
    try:
        assert add_slices(skewed(spark, 30), ["k"], ["t"]) is None
    finally:
        spark.conf.unset("spark.topiclake.rowsPerTask")


def test_latest_of_rows_with_maps(spark):
    df = spark.sql("SELECT * FROM VALUES ('+U', 'a', 1, named_struct('m', map('x', 1))), ('+U', 'a', 2, named_struct('m', map('x', 2))) AS t(row_kind, id, n, s)")
    assert C.latest(df, ["id"], ["n"]).select("s.m").first().m == {"x": 2}


# temporal joins -----------------------------------------------------------------------


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame(
        [(1, "a", at(5)), (2, "a", at(10)), (3, "a", at(25)), (4, "b", at(1)), (5, None, at(50)), (6, "a", None), (7, "a", at(40))],
        "view INT, user STRING, viewed TIMESTAMP",
    )
    right = spark.createDataFrame(
        [("a", at(10), "v1", False), ("a", at(20), "v2", False), ("a", at(30), None, True), ("b", at(2), "w1", False), (None, at(1), "none", False)],
        "user STRING, since TIMESTAMP, name STRING, gone BOOLEAN",
    )
    return left, right


@pytest.mark.parametrize("few", [0, 100])
def test_as_of(sides, few):
    left, right = sides
    more = {"deleted": "gone", "broadcast_versions": few}
    joined = as_of_join(left, right, ["user"], "viewed", "since", **more)
    assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) == bool(few)
    got = rows(joined, "view", "name")
    # before the first version, at its time, after the next, another key, without key, without time, after a delete
    assert got == [(1, None), (2, "v1"), (3, "v2"), (4, None), (5, None), (6, None), (7, None)]
    inner = as_of_join(left, right, ["user"], "viewed", "since", "inner", **more)
    assert rows(inner, "view", "name") == [(2, "v1"), (3, "v2")]


@pytest.mark.parametrize("kind", ["INT", "BIGINT", "DATE", "TIMESTAMP", "TIMESTAMP_NTZ"])
@pytest.mark.parametrize("limit", [1, 10**9])
def test_as_of_kinds_of_time(spark, kind, limit):
    make = {"INT": "CAST({} AS INT)", "BIGINT": "CAST({} AS BIGINT)", "DATE": "date_from_unix_date({})"}.get(
        kind, f"CAST(timestamp_seconds({{}}) AS {kind})"
    )
    views = ", ".join(f"({i}, {make.format(t)})" for i, t in enumerate((1, 5, 9, 12)))
    left = spark.sql(f"SELECT 'a' AS user, viewed, view FROM VALUES {views}, (9, NULL) AS t(view, viewed)")
    right = spark.sql(f"SELECT 'a' AS user, since, version FROM VALUES ({make.format(3)}, 'x'), ({make.format(9)}, 'y') AS t(since, version)")
    spark.conf.set("spark.topiclake.rowsPerTask", str(limit))
    try:
        for few in (0, 100):
            got = as_of_join(left, right, ["user"], "viewed", "since", broadcast_versions=few)
            assert rows(got, "view", "version") == [(0, None), (1, "x"), (2, "y"), (3, "y"), (9, None)]
    finally:
        spark.conf.unset("spark.topiclake.rowsPerTask")


@pytest.mark.parametrize("few", [0, 100])
def test_as_of_same_time(spark, few):
    left = spark.createDataFrame([("a", at(3))], "user STRING, viewed TIMESTAMP")
    right = spark.createDataFrame([("a", at(3), 1), ("a", at(3), 2)], "user STRING, since TIMESTAMP, version INT")
    got = as_of_join(left, right, ["user"], "viewed", "since", right_order=["version"], broadcast_versions=few)
    assert rows(got, "version") == [(2,)]


def test_many_versions_of_a_key_are_not_broadcast(spark):
    left = spark.range(3).select(F.lit("a").alias("user"), F.timestamp_seconds("id").alias("viewed"))
    right = spark.range(300).select(F.lit("a").alias("user"), F.timestamp_seconds("id").alias("since"), F.col("id").alias("version"))
    joined = as_of_join(left, right, ["user"], "viewed", "since")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined, "version") == [(0,), (1,), (2,)]


def test_large_versions_are_not_broadcast(spark):
    left = spark.range(3).select(F.col("id").alias("user"), F.timestamp_seconds("id").alias("viewed"))
    text = F.repeat(F.lit("x"), 1024 * 1024)
    right = spark.range(40).select(F.col("id").alias("user"), F.timestamp_seconds(F.lit(0)).alias("since"), text.alias("body"))
    joined = as_of_join(left, right, ["user"], "viewed", "since").select("user", F.length("body").alias("n"))
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert {r.n for r in joined.collect()} == {1024 * 1024}


def test_as_of_refuses(sides):
    left, right = sides
    with pytest.raises(ValueError):
        as_of_join(left, right, ["user"], "viewed", "since", "outer")
    with pytest.raises(ValueError, match="name"):
        as_of_join(left.withColumn("name", F.lit(1)), right, ["user"], "viewed", "since")


def test_intervals_agree_with_as_of(spark):
    changes = upserts(spark, ("a", 1), ("a", 2), ("a", None), ("a", 4), ("b", 9))
    got = intervals(changes, ["id"], "publish_time", ["entry_id"])
    seconds = got.select("id", "v", F.unix_seconds("valid_from") - 1704067200, F.unix_seconds("valid_to") - 1704067200)
    assert rows(seconds, *seconds.columns) == [("a", 1, 0, 1), ("a", 2, 1, 2), ("a", 4, 3, None), ("b", 9, 4, None)]
