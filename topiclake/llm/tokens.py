"""Token ids of many texts: each distinct piece is tokenized once.

A byte-level BPE tokenizer cuts a text into pieces first and works on each piece alone.
For characters below LATIN the cut is made here for a whole chunk of texts with arrays,
and the tokenizer's model makes the ids of each piece; texts with other characters or with an added
token of the file, and all texts for tokenizers that are cut otherwise, go to the tokenizer as they are.  Pieces are
known by a 64-bit hash, and the ids of up to CACHED pieces stay in the worker.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from tokenizers import Tokenizer

from topiclake.llm.words import Texts, hash_spans

LATIN = 0x250
CACHED = 2_000_000

SPACE, LETTER, NUMBER, OTHER = range(4)
# fixed value: white space below LATIN
_BLANKS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    kinds = np.full(LATIN, OTHER, np.uint8)
    for code in range(LATIN):
        if regex.match(r"\p{L}", chr(code)):
            kinds[code] = LETTER
        elif regex.match(r"\p{N}", chr(code)):
            kinds[code] = NUMBER
    kinds[_BLANKS] = SPACE
    return kinds


def piece_starts(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each character; all characters are below LATIN."""
    n = len(codes)
    if not n:
        return np.zeros(0, bool)
    kind = _kinds()[codes]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    text_begins, text_ends = first[:-1], first[1:]
    run = text_begins.copy()
    run[1:] |= kind[1:] != kind[:-1]
    blank = kind == SPACE
    after_blank = np.zeros(n, bool)
    after_blank[1:] = (codes[:-1] == 0x20) & ~text_begins[1:]
    starts = run.copy()
    # the last blank before a word stands alone or, if it is a space, goes with the word
    last = blank & ~text_ends
    last[:-1] &= ~blank[1:]
    last[-1] = False
    starts |= last
    starts[run & ~blank & after_blank] = False
    # 's 't 'm 'd 're 've 'll after anything but a space
    quote = np.flatnonzero((codes[:-1] == ord("'")) & run[:-1] & ~after_blank[:-1] & ~text_ends[:-1])
    if len(quote):
        one = codes[quote + 1]
        two = np.where((quote + 2 < n) & ~text_ends[quote + 1], codes[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for some, size in ((quote[short], 2), (quote[long & ~short], 3)):
            starts[some + 1] = False
            after = some + size
            inner = after < n
            inner[inner] = ~text_begins[after[inner]] & (kind[after[inner]] == LETTER)
            starts[after[inner]] = True
    return starts


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, str]:
    """How byte-level models write bytes: visible Latin-1 as it is, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def _cut_as_here(path: str) -> bool:
    """Whether the tokenizer cuts by the byte-level pattern and changes nothing before."""
    with open(path) as file:
        parts = json.load(file)
    cut = parts.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    return plain and not parts.get("normalizer") and parts["model"].get("type", "BPE") == "BPE"


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, where one of each is, and the number of each value's own."""
    order = np.argsort(names)
    new = np.ones(len(names), bool)
    new[1:] = names[order[1:]] != names[order[:-1]]
    number = np.empty(len(names), np.int64)
    number[order] = np.cumsum(new) - 1
    return names[order[new]], order[new], number


class Encoder:
    """Token ids of texts by a tokenizer file."""

    def __init__(self, path: str, cached: int = CACHED):
        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        # a look ahead, so that tokens that overlap are all found
        self.added = re.compile(f"(?={'|'.join(added)})") if added else None
        self.cached = cached
        self.by_pieces = _cut_as_here(path)
        self._forget()

    def _forget(self) -> None:
        self.names, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begins, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        tokenize, letters = self.tokenizer.model.tokenize, _byte_letters()
        return [[t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))] for p in pieces]

    def _slots_of(self, names: np.ndarray, spelling) -> np.ndarray:
        """Where the ids of each piece are; ``names`` ascend."""
        if len(self.names) + len(names) > self.cached:
            self._forget()
        at = np.searchsorted(self.names, names)
        known = np.zeros(len(names), bool)
        if len(self.names):
            known = self.names[np.minimum(at, len(self.names) - 1)] == names
        new = np.flatnonzero(~known)
        if len(new):
            ids = self._encode_pieces([spelling(i) for i in new.tolist()])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            slots = len(self.begins) - 1 + np.arange(len(new))
            self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))])
            self.names = np.insert(self.names, at[new], names[new])
            self.slots = np.insert(self.slots, at[new], slots)
            at = np.searchsorted(self.names, names)
        return self.slots[at]

    def encode(self, texts: Texts) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each text its ids, and the places in them after which a sentence ends."""
        text = texts.data.tobytes().decode("utf-8", "replace")
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        begins = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
        offsets = begins[texts.offsets]
        other = (codes >= LATIN) | (not self.by_pieces)
        if self.added:
            other[[found.start() for found in self.added.finditer(text)]] = True
        foreign = np.concatenate([[0], np.cumsum(other)])[offsets]
        starts = np.flatnonzero(piece_starts(np.minimum(codes, LATIN - 1), offsets))
        ends = np.append(starts[1:], len(codes))
        pieces = np.searchsorted(starts, offsets)
        # pieces of texts with other characters mean nothing and are not tokenized
        use = np.zeros(len(starts), bool)
        for i in np.flatnonzero(np.diff(foreign) == 0):
            use[pieces[i] : pieces[i + 1]] = True
        keep = np.flatnonzero(use)
        names, first, number = _distinct(hash_spans(codes, starts[keep], ends[keep]))
        first, inverse = keep[first], np.zeros(len(starts), np.int64)
        inverse[keep] = number
        slots = self._slots_of(names, lambda i: text[starts[first[i]] : ends[first[i]]])
        sizes = (self.begins[1:] - self.begins[:-1])[slots]
        size = sizes[inverse] * use if len(slots) else np.zeros(len(starts), np.int64)
        at = np.concatenate([[0], np.cumsum(size)])
        source = np.repeat(self.begins[slots[inverse]] - at[:-1], size) + np.arange(at[-1]) if len(slots) else np.zeros(0, np.int64)
        ids = self.ids[source]
        final = np.isin(codes[ends - 1], [ord(c) for c in ".!?\n"]) if len(starts) else np.zeros(0, bool)
        all_ids, all_breaks = [], []
        for i in range(len(texts)):
            if foreign[i + 1] > foreign[i]:
                own = np.array(self._encode([text[offsets[i] : offsets[i + 1]]])[0], np.uint32)
                all_ids.append(own)
                all_breaks.append(np.flatnonzero(np.isin(own, self._final_ids())) + 1)
            else:
                a, b = pieces[i], pieces[i + 1]
                all_ids.append(ids[at[a] : at[b]])
                all_breaks.append(at[a + 1 : b + 1][final[a:b]] - at[a])
        return all_ids, all_breaks

    @lru_cache(maxsize=1)
    def _final_ids(self) -> list[int]:
        return sorted({i for ids in self._encode([".", "!", "?", "\n", "。", "！", "？"]) for i in ids[-1:]})


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder for each worker."""
    return Encoder(path)
