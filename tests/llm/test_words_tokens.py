"""Words, pieces and ids against plain regular expressions and the tokenizer itself."""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from topiclake.llm.tokens import Encoder
from topiclake.llm.words import LETTERS, chunks, windows

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["'", "'s", "'re", " ", "  ", "\n", "\t", "\x0b", "a", "Be", "é", "1", ".", "!?", "<|endoftext|>", "中", "don't", "\x85", "_"]
texts = st.lists(st.one_of(st.none(), st.lists(st.sampled_from(ODD), max_size=12).map("".join), st.text(max_size=20)), max_size=6)


def batch(values):
    return pa.RecordBatch.from_pydict({"text": pa.array(values, pa.string())})


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words(values):
    values = [v if v is None else v.encode("utf-8", "ignore").decode() for v in values]
    for table, lower, pattern in ((None, False, r"[^\x20\x09-\x0D]+"), (LETTERS, True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        found = []
        for chunk in chunks(batch(values), limit=7):
            words = chunk.words(lower=lower) if table is None else chunk.words(table, lower)
            raw = words.data.tobytes()
            spelt = [raw[a:b].decode() for a, b in zip(words.starts, words.ends)]
            found += [spelt[a:b] for a, b in zip(words.offsets, words.offsets[1:])]
        ascii_lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
        plain = [(v or "").translate(ascii_lower) if lower else v or "" for v in values]
        assert found == [re.findall(pattern, v) for v in plain]


def test_hashes_follow_words():
    chunk = next(chunks(batch(["one two one two", "two one", None, ""])))
    words = chunk.words()
    h = words.hashes()
    assert h[0] == h[2] == h[5] and h[1] == h[3] == h[4] and h[0] != h[1]
    w = windows(h, 2)
    assert w[0] == w[2] and w[0] != w[1] and w[1] == w[4]


@settings(max_examples=150, deadline=None)
@given(texts)
def test_ids_are_the_tokenizers(values):
    values = [v if v is None else v.encode("utf-8", "ignore").decode() for v in values]
    own = test_ids_are_the_tokenizers.__dict__.setdefault("encoder", Encoder(PATH, cached=50))
    found = [ids.tolist() for chunk in chunks(batch(values)) for ids in own.encode(chunk)[0]]
    assert found == own._encode([v or "" for v in values])


def test_added_tokens_are_the_files():
    end = "<|endoftext|>"
    values = [f"a{end}b", "a<|endof", "text|>b", f"{end}{end}", f"a. {end} é!{end}", "plain. Text", None, f"中{end}", "<|endoftext|", ">"]
    plain = Tokenizer.from_file(PATH)
    found = [ids.tolist() for chunk in chunks(batch(values)) for ids in Encoder(PATH).encode(chunk)[0]]
    assert found == [plain.encode(v or "", add_special_tokens=False).ids for v in values]
    assert found[0] == [64, 50256, 65]


def test_chunks_never_cut_a_text():
    sizes = [len(c) for c in chunks(batch(["a" * 50, "b", "c", "d" * 9]), limit=10)]
    assert sizes == [1, 2, 1] and [c.data.size for c in chunks(batch([]))] == []
    assert np.diff(next(chunks(batch([None, "é"]))).offsets).tolist() == [0, 2]
