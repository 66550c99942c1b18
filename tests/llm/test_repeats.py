from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from topiclake.llm import repeats

DOCS = "doc_id long, text string, spans string, kept string"


def brute(docs, length):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (name, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((name, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    shared = [" ".join(word() for _ in range(n)) for n in (20, 40, 120)]
    docs = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            begin = rng.randint(0, 30)
            parts += [passage[begin : begin + rng.randint(40, 400)], " ".join(word() for _ in range(rng.randint(0, 9)))]
        docs.append((i, "".join(parts)))
    docs += [(60, docs[3][1]), (60, docs[3][1]), (61, None), (None, ""), (None, docs[5][1]), (62, "ab" * 200), (63, "z" * 300)]
    return docs


@pytest.mark.parametrize("seed, hot_bytes", [(1, repeats.HOT_BYTES), (2, 0)])
def test_every_repeated_string_goes(spark, seed, hot_bytes):
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    found = repeats.remove_repeats(df, length=80, hot_bytes=hot_bytes).collect()
    got = [(r.doc_id, r.n_bytes, sum(s["last"] - s["first"] for s in r.spans), len(r.spans), r.kept_sha256) for r in found]
    assert sorted(got, key=str) == brute(docs, 80)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_nothing_repeats(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert [r.spans for r in repeats.remove_repeats(df).collect()] == [[], []]
    assert repeats.remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_run_index(seed):
    rng = random.Random(seed)
    base = bytes(rng.choices(b"ab", k=400))
    parts = list(dict.fromkeys(base[(b := rng.randint(0, 300)) : b + rng.randint(20, 80)] for _ in range(50)))
    index = repeats.RunIndex(parts)
    assert index.runs < index.n
    flags, begin = index.repeated(20), 0
    seen = Counter(p[i : i + 20] for p in parts for i in range(len(p) - 19))
    for p in parts:
        assert [bool(f) for f in flags[begin : begin + len(p) - 19]] == [seen[p[i : i + 20]] > 1 for i in range(len(p) - 19)]
        begin += len(p) + 1
