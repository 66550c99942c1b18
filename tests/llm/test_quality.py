from __future__ import annotations

import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from topiclake.llm import quality

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, kept string, n_words int"


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    repeated, seen = set(), {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            repeated |= {p + k for p in places for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_counts(spark):
    values = [None, "", "a b c a b c", "é é é é", "x\n\nx\n x\nx", "#*$ %&|<> \x0b\x0c ", "w " * 60, " ".join(map(str, range(60))), "a\nb\na\n"]
    df = spark.createDataFrame([(i, v, "k", 1) for i, v in enumerate(values)] + [(None, "q", "k", 1), (1, "", "k", 1)], DOCS)
    got = quality.judge(df, None).collect()
    assert len(got) == len(values) + 2
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(values[r.doc_id])
        assert r.probability is None and r.kept == (not r.base_failed)
    assert quality.judge(df.limit(0), None).count() == 0
    assert [r.doc_id for r in quality.keep_good(df, None).collect()] == [7]
    assert quality.keep_good(df, None).columns == df.columns


def test_counts_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = dict(duckdb.execute(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall())
    for r in quality.judge(docs, None).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(rows[r.doc_id])


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    held = quality.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = [r.kept == (r.quality == 1) for r in held if not r.base_failed]
    assert np.mean(right) > 0.95
    kept = [r.kept for r in held if r.quality == 1 and not r.base_failed]
    assert np.mean(kept) > 0.97
    assert all(0 <= r.probability <= 1 for r in held)


@pytest.mark.parametrize("rows", [[], [(0, 1, 0)], [(0, None, 0), (None, 1, 0)]])
def test_too_few_labels(spark, rows):
    docs = spark.createDataFrame([(0, "a b", "k", 1)], DOCS)
    assert quality.train(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")) is None


def test_probabilities_are_calibrated():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, 4000)
    good = (rng.random(4000) < 1 / (1 + np.exp(-(1.5 * z - 1)))).astype(float)
    slope, shift = quality._calibrate(z, good, np.ones(4000))
    assert abs(slope - 1.5) < 0.15 and abs(shift + 1) < 0.15
    assert quality.fit(pa.table({"doc_id": [1], "good": [1], "numbers": [[1]], "values": [[1.0]]}), (0, 1)) is None
