from __future__ import annotations

import random
import re

import numpy as np
import pytest

from topiclake.llm import decontaminate as dc
from topiclake.llm.suffixes import suffix_order

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, items string, n_chars long"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for name, phrase in items:
        w = words(phrase)
        if name is None or not w:
            continue
        size = min(10, len(w))
        grams = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(name)
    return len(own), hit, sorted(found)


@pytest.mark.parametrize("seed, block", [(1, dc.BLOCK_BYTES), (2, 200)])
def test_windows_are_found(spark, seed, block):
    rng = random.Random(seed)
    vocabulary = [f"{c}{d}" for c in "abcé" for d in range(4)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 30]))) for i in range(12)] + [(3, text(14)), (20, None), (21, "!?"), (None, text(12))]
    docs = []
    for i in range(40):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            w = words(rng.choice(items)[1])
            begin = rng.randint(0, max(0, len(w) - 5))
            parts += [", ".join(x.upper() if x.isascii() else x for x in w[begin : begin + rng.randint(5, 25)]), f"zz {text(rng.randint(0, 5))}"]
        docs.append((i, ". ".join(parts)))
    docs += [(1, docs[1][1]), (None, docs[2][1]), (77, None), (78, ""), (79, items[4][1])]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    by_text = {t: brute(t, items) for _, t in docs}
    got = dc.decontaminate(df, bench, block).collect()
    assert len(got) == len(docs)
    for r in got:
        n, hit, found = by_text[r.text]
        assert (r.n_words, {i for a, b in r.spans for i in range(a, b)}, r.items) == (n, hit, found)
        assert words(r.clean_text) == [w for i, w in enumerate(words(r.text)) if i not in hit]
    clean = dc.clean(df, bench, block)
    assert clean.columns == df.columns and clean.count() == len(docs)
    assert all(r.items == "x" and (r.text is None) == (r.doc_id == 77) for r in clean.collect())


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", "x", 1)], DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.items for r in dc.decontaminate(df, none).collect()] == [[]]
    assert dc.decontaminate(df.limit(0), none).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_index_finds_and_locates(seed):
    rng = np.random.default_rng(seed)
    sequence = np.append(rng.integers(1, 4, 300), 0)
    index = dc.FmIndex(sequence, 3, sampled=8)
    phrases = rng.integers(1, 4, (40, 5))
    lengths = rng.integers(1, 6, 40)
    low, high = index.search(phrases, lengths)
    for p, size, a, b in zip(phrases, lengths, low, high):
        want = [i for i in range(301 - size) if (sequence[i : i + size] == p[:size]).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_suffix_order():
    rng = random.Random(5)
    for _ in range(20):
        s = [rng.randint(0, 2) for _ in range(rng.randint(0, 60))]
        assert suffix_order(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
