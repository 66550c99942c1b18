from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from topiclake.llm import whitening
from topiclake.llm.queries.embeddings import op12_embedding_whitening

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """Covariance by its definition in exact fractions, and what follows from it."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, dims = len(kept), len(kept[0][1])
    sums = [sum(x[d] for _, x in kept) for d in range(dims)]
    off = [[n * x[d] - sums[d] for d in range(dims)] for _, x in kept]
    cov = np.array([[float(Fraction(sum(o[a] * o[b] for o in off), n**3)) for b in range(dims)] for a in range(dims)])
    return kept, n, sums, [sum(v * v for v in o) for o in off], cov


def sample(seed, n, dims):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dims, dims)) * np.linspace(0.2, 2, dims)
    return [(i, [float(v) for v in row], 0) for i, row in enumerate(rng.normal(size=(n, dims)) @ mix + rng.normal(size=dims))]


def test_against_fractions(spark, path):
    rows = sample(1, 300, 12)
    rows += [(1000, None, 0), (1001, [None] * 12, 1), (1002, [float("nan")] * 12, 1), (1003, [float("inf")] + [0.0] * 11, 1), (1004, [float("-inf")] * 12, 1), (None, rows[0][1], None), (0, rows[0][1], 0), (1005, [], 0)]
    folder = path("vectors")
    spark.createDataFrame(rows, ROWS).repartition(7).write.parquet(f"{folder}/embeddings.parquet")
    kept, n, sums, deviation, cov = brute(rows)
    model = whitening.fit(spark.read.parquet(f"{folder}/embeddings.parquet"))
    assert model.n == n == 302 and model.sums == sums
    assert np.array_equal(model.covariance, cov)  # to the last bit
    got = op12_embedding_whitening(spark, folder).collect()
    assert len(got) == n * 8 and {r.component for r in got} == set(range(1, 9))
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    mean = np.array([Fraction(s, n) for s in sums])
    want = {}
    for (i, x), d in zip(kept, deviation):
        white = (np.array([float(a - m) for a, m in zip(x, mean)]) @ vectors[:, :8]) / np.sqrt(values[:8])
        for c in range(8):
            want.setdefault((i, c + 1), []).append((d, white[c]))
    sign = {}
    for r in got:
        choices = want[r.vec_id, r.component]
        assert any(r.deviation == d and math.isclose(abs(r.whitened), abs(w), rel_tol=1e-6, abs_tol=1e-9) for d, w in choices)
        if r.vec_id == 5:
            sign[r.component] = math.copysign(1, r.whitened * choices[0][1])
        assert r.n == n and math.isclose(r.explained, values[r.component - 1] / np.trace(cov), rel_tol=1e-9) and r.identity_error < 1e-9
    for r in got:  # either sign, the same for all rows
        assert any(math.isclose(r.whitened, sign[r.component] * w, rel_tol=1e-6, abs_tol=1e-9) for _, w in want[r.vec_id, r.component])


@pytest.mark.parametrize("size", [1e4, 1e12, 3e30])
def test_large_entries_stay_exact(spark, size):
    rows = [(i, [size * (i % 3 - 1), 0.5 * i, -size, size / 3], 0) for i in range(6)]
    model = whitening.fit(spark.createDataFrame(rows, ROWS))
    bound = 2**62
    whole = [[min(max(math.floor(1024 * float(np.float32(c))), -bound), bound) + 100_000 for c in v] for _, v, _ in rows]
    sums = [sum(x[d] for x in whole) for d in range(4)]
    assert model.sums == sums
    for a in range(4):
        for b in range(4):
            exact = Fraction(sum((6 * x[a] - sums[a]) * (6 * x[b] - sums[b]) for x in whole), 6**3)
            assert model.covariance[a, b] == float(exact)
    rows = whitening.whiten(spark.createDataFrame(rows, ROWS), model).collect()
    for r, x in zip(sorted(rows, key=lambda r: r.vec_id), whole):
        d = sum((6 * v - s) ** 2 for v, s in zip(x, sums))
        assert r.deviation == (d if d < 2**63 else None)


def test_little_or_nothing(spark, path):
    empty = spark.createDataFrame([(1, None, 0)], ROWS)
    assert whitening.components(empty).count() == 0 and whitening.fit(empty).n == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(3)], ROWS)  # no variance: no component
    assert whitening.components(same).count() == 0
    assert [list(r.whitened) for r in whitening.whiten(same, whitening.fit(same)).collect()] == [[], [], []]
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0], 0) for i in range(5)], ROWS)  # one direction only
    assert whitening.components(line).count() == 5


def test_lengths_and_clashing_names(spark):
    rows = [(i, [float(i % 5), float(i % 3)], i) for i in range(30)] + [(99, [1.0], 0), (98, [1.0, 2.0, 3.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int").withColumn("row", F.lit("r")).withColumn("deviation", F.lit("d"))
    model = whitening.fit(df)
    assert model.n == 30 and len(model.sums) == 2
    got = whitening.whiten(df, model)
    assert got.columns == ["vec_id", "embedding", "n", "row", "deviation", "whitened"] and got.count() == 30
    parts = whitening.components(df)
    assert parts.count() == 60 and parts.select("n").distinct().collect()[0].n == 30
