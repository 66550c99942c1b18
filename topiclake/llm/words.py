"""Text of an Arrow batch as arrays: bytes, words, hashes of words and of word windows.

A batch is taken in chunks of about CHUNK bytes, so that the arrays stay small whatever
the size of a batch; a text is never cut.  Words are runs of bytes that a table of 256
flags calls word bytes; all classes used here treat every byte of a non-ASCII character
alike, so that bytes and characters give the same words.  A NULL text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21

# fixed values: white space that separates words
SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def _spaced() -> np.ndarray:
    table = np.ones(256, bool)
    table[list(SPACE)] = False
    return table


def _letters() -> np.ndarray:
    """Digits, a to z and all bytes of other scripts."""
    table = np.zeros(256, bool)
    table[ord("0") : ord("9") + 1] = True
    table[ord("a") : ord("z") + 1] = True
    table[0x80:] = True
    return table


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


SPACED, LETTERS, LOWER = _spaced(), _letters(), _lower()

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE), np.full(size, INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    return _powers(1 << max(22, int(n).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; one number for each number (the splitmix finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``values``; equal spans have equal hashes."""
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * BASE)


@dataclass
class Texts:
    """Texts of a chunk, one after the other, and the words in them."""

    rows: pa.RecordBatch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # of texts in data, one more than texts

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, table: np.ndarray = SPACED, lower: bool = False) -> Words:
        data = LOWER[self.data] if lower else self.data
        inside = table[data]
        n = len(data)
        first, last = inside.copy(), inside.copy()
        if n:
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            at = self.offsets[:-1][self.offsets[:-1] < n]
            first[at] = inside[at]
            at = self.offsets[1:][self.offsets[1:] > 0] - 1
            last[at] = inside[at]
        starts = np.flatnonzero(first)
        return Words(data, inside, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, self.offsets))


@dataclass
class Words:
    data: np.ndarray
    inside: np.ndarray  # whether a byte belongs to a word
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # of texts in the words, one more than texts

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)

    def text_of(self) -> np.ndarray:
        """The number of its text for each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each word on; those past a text's end mean nothing."""
    n = max(0, len(hashes) - size + 1)
    total = np.full(n, np.uint64(size))
    for i in range(size):
        total = total * BASE + hashes[i : i + n]
    return mix(total)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK) -> Iterator[Texts]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text, one row at least."""
    texts = batch.column(batch.schema.get_field_index(column))
    kind = pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string()
    texts = texts.fill_null(b"" if kind == pa.large_binary() else "").cast(kind)
    count = len(texts)
    if not count:
        return
    _, ends, values = texts.buffers()
    offsets = np.frombuffer(ends, np.int64, count + 1, texts.offset * 8)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    at = 0
    while at < count:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, count)
        yield Texts(batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to
