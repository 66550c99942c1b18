from __future__ import annotations

import random
import re

import pytest

from topiclake.llm import near_copies as nc
from topiclake.llm.components import connected

DOCS = "doc_id long, text string, kept string, row_key string"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    above = list(range(len(docs)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                above[top(i)] = top(j)
    groups: dict = {}
    for i, (d, _) in enumerate(docs):
        groups.setdefault(top(i), []).append(d)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [(d, len(sets[i]), least[top(i)], d == least[top(i)]) for i, (d, _) in enumerate(docs)], [top(i) for i in range(len(docs))], sets


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(n)] for n in (3, 8, 40, 120, 300)]
    docs = []
    for d in range(90):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append((d, rng.choice([" ", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    rng.shuffle(docs)
    return docs + [(100, None), (101, ""), (102, " \n"), (None, docs[0][1]), (103, "One two"), (104, "one TWO"), (3, "lonely text"), (105, docs[1][1])]


def key(row):
    return str(row)


@pytest.mark.parametrize("seed, rounds, short, block", [(1, 2, 32, 256), (2, 0, 0, 4), (3, 1, 2, 5)])
def test_components(spark, monkeypatch, seed, rounds, short, block):
    monkeypatch.setattr(nc, "ROUNDS", rounds)
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    got = [tuple(r) for r in nc.near_copies(df, short, block).collect()]
    assert sorted(got, key=key) == sorted(brute(docs)[0], key=key)


def test_one_of_each_group_stays(spark):
    docs = corpus(4)
    docs += [docs[0], docs[0], (100, None)]
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS)
    got = nc.keep_first(df)
    assert got.columns == df.columns
    _, roots, sets = brute(docs)
    rows = got.collect()
    assert len(rows) == len({r for r, s in zip(roots, sets) if s}) + sum(not s for s in sets)
    kept = brute([(r.doc_id, r.text) for r in rows])
    assert len(set(kept[1])) == len(rows)
    assert nc.keep_first(df.limit(0)).count() == nc.near_copies(df.limit(0)).count() == 0


@pytest.mark.parametrize("per_task", [1_000_000, 7])
def test_connected(spark, per_task):
    rng = random.Random(per_task)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randint(50, 90), rng.randint(50, 90)) for _ in range(30)] + [(5, 5), (None, 3), (7, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected(df, per_task).collect()}
    above = {}

    def top(x):
        while above.get(x, x) != x:
            x = above[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
            above.setdefault(min(x, y), min(x, y))
    assert got == {n: top(n) for n in above}
    assert connected(df.limit(0)).count() == 0
