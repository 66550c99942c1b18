from __future__ import annotations

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from topiclake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, ids string"


def cost(cuts, penalties, chosen, length):
    total = 0
    for a, b in itertools.pairwise(chosen):
        size = cuts[b] - cuts[a]
        if size > length:
            return None
        free = size >= packing.SHORTEST and size & (size - 1) == 0
        total += (0 if free else length - size) + penalties[b] + packing.WINDOW
    return total


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_the_best(seed, monkeypatch):
    monkeypatch.setattr(packing, "SHORTEST", 2)
    rng, length = np.random.default_rng(seed), 16
    cuts = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 11))])
    penalties = rng.choice([0, 4, 9], len(cuts))
    inner = range(1, len(cuts) - 1)
    ways = [[0, *some, len(cuts) - 1] for k in range(len(cuts) - 1) for some in itertools.combinations(inner, k)]
    least = min(c for w in ways if (c := cost(cuts, penalties, w, length)) is not None)
    assert cost(cuts, penalties, packing.best_cuts(cuts, penalties, length), length) == least


def test_round_trip(spark):
    long = "A sentence of words. " * 700
    docs = [(1, "One. Two three.", "en", "x"), (2, None, None, None), (None, "", "en", "x"), (4, long, "en", "x"), (4, long, "en", "x"), (5, "x" * 9000, "en", "x")]
    df = spark.createDataFrame(docs, DOCS).coalesce(1)
    rows = packing.pack(df, PATH, block=2000).collect()
    tokenizer = Tokenizer.from_file(PATH)
    windows: dict = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length > 0
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in windows.values():
        ends = 0
        for offset, size in sorted(pieces):
            assert offset == ends
            ends += size
        assert ends <= 1024
    # in order of the input, and each id once
    stream = b"".join(r.ids for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)))
    want = [i for _, text, *_ in docs for i in [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]]
    assert np.frombuffer(stream, "<u4").tolist() == want
    sizes = [sum(s for _, s in p) for p in windows.values()]
    padding = sum(0 if s & (s - 1) == 0 else 1024 - s for s in sizes)
    assert padding < 0.1 * sum(sizes) + 1024
    assert zlib.crc32(rows[0].ids) >= 0


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0
