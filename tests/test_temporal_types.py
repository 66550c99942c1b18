from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from helpers import rows
from topiclake.operators.temporal import as_of_join

DAY = dt.date(2024, 1, 1)
KINDS = {
    "tinyint": lambda i: i,
    "smallint": lambda i: i,
    "int": lambda i: i,
    "bigint": lambda i: i * 10**12,
    "float": lambda i: i / 4,
    "double": lambda i: i / 8,
    "decimal(20,3)": lambda i: Decimal(i) / 8,
    "date": lambda i: DAY + dt.timedelta(days=i),
    "timestamp": lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i),
    "timestamp_ntz": lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i),
    "string": lambda i: f"{i:03}",
    "binary": lambda i: bytes([i]),
    "boolean": lambda i: i > 20,
    "interval day to second": lambda i: dt.timedelta(seconds=i),
    "array<int>": lambda i: [i, 1],
    "struct<a:int>": lambda i: (i,),
}


def brute(left, right):
    out = []
    for number, key, t in left:
        fits = [r for r in right if r[0] == key and None not in (key, t) and r[1] is not None and r[1] <= t]
        last = max(fits, key=lambda r: (r[1], (r[2] is not None, r[2])), default=None)
        out.append((number, None if last is None or last[4] else last[3]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("kind", "tie"), [*zip(KINDS, ["date", "decimal(20,3)", "string", "timestamp"] * 4), ("date", "boolean"), ("string", "struct<a:int>")])
def test_every_type_in_both_paths(spark, kind, tie):
    rng, value, order = random.Random(kind + tie), KINDS[kind], KINDS[tie]
    some = lambda: value(rng.randint(0, 40)) if rng.random() < 0.9 else None
    left = [(i, rng.choice(["a", "b", None]), some()) for i in range(60)]
    # ties differ, so that one version is the last of its time
    right = [(rng.choice(["a", "b", None]), some(), order(i) if i else None, i, rng.random() < 0.2) for i in range(40)]
    right = right[:3] if tie == "boolean" else right
    if kind == "boolean":
        right = right[:6]
    l_df = spark.createDataFrame(left, f"number int, k string, t {kind}")
    r_df = spark.createDataFrame(right, f"k string, since {kind}, tie {tie}, name int, gone boolean")
    want = brute(left, right)
    for limit in (0, 20_000):
        got = as_of_join(l_df, r_df, ["k"], "t", "since", right_order=["tie"], deleted="gone", broadcast_versions=limit)
        assert sorted(rows(got, "number", "name"), key=str) == want
