"""Benchmark decontamination with an FM-index per training shard.

A shard is a chunk of texts of a task.  Its words become symbols of the test phrases'
vocabulary; words that no phrase has end a run, and runs shorter than the shortest phrase
are left out, so nothing that could match is lost and the index holds little else.  The
index is a wavelet matrix over the Burrows-Wheeler transform, with suffix positions sampled
every SAMPLED symbols.  All phrases are searched backwards at once, located by walking to the
next sample, compared word by word with the text, and merged into spans.

Test phrases are windows of WINDOW words of an item; a shorter item is one window.
The benchmark is a stated query set and goes to the tasks in blocks of at most BLOCK_BYTES
of text (one item at least), one pass over the documents for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from topiclake.llm.suffixes import suffix_order
from topiclake.llm.tables import as_row, let_workers_import, with_text, written
from topiclake.llm.words import LETTERS, Texts, chunks

WINDOW = 10
BLOCK_BYTES = 4 << 20
SAMPLED = 8


@dataclass
class Phrases:
    """The test phrases of a block; symbols count from 1 in the order of the words' hashes."""

    hashes: np.ndarray
    words: list[bytes]
    symbols: np.ndarray  # a row for each phrase, 0 after its end
    lengths: np.ndarray
    items: list[list[int]] = field(default_factory=list)  # of each phrase


def phrases_of(items: list[tuple[int, str | None]], window: int = WINDOW) -> Phrases:
    rows = pa.RecordBatch.from_pydict({"text": pa.array([text for _, text in items], pa.string())})
    found: dict[tuple[bytes, ...], set[int]] = {}
    vocabulary: dict[bytes, int] = {}
    at = 0
    for texts in chunks(rows):
        words = texts.words(LETTERS, lower=True)
        hashes, raw = words.hashes().tolist(), words.data.tobytes()
        spelt = [raw[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())]
        vocabulary.update(zip(spelt, hashes))
        for begin, end in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
            for first in range(begin, max(begin + 1, end - window + 1)) if end > begin else ():
                found.setdefault(tuple(spelt[first : min(end, first + window)]), set()).add(items[at][0])
            at += 1
    order = sorted(vocabulary, key=vocabulary.get)
    number = {word: i + 1 for i, word in enumerate(order)}
    symbols = np.zeros((len(found), window), np.int64)
    for row, phrase in enumerate(found):
        symbols[row, : len(phrase)] = [number[word] for word in phrase]
    return Phrases(
        np.array([vocabulary[w] for w in order], np.uint64), order, symbols,
        np.array([len(p) for p in found], np.int64), [sorted(i) for i in found.values()],
    )


class FmIndex:
    """Finds and locates phrases in a sequence of symbols 1 .. top that ends with a single 0."""

    def __init__(self, sequence: np.ndarray, top: int, sampled: int = SAMPLED):
        order = suffix_order(sequence)
        last = sequence[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=top + 1))])
        self.levels = []  # zeros before each place, by bit from the highest
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            zero = (last >> bit) & 1 == 0
            self.levels.append((bit, np.concatenate([[0], np.cumsum(zero)])))
            last = np.concatenate([last[zero], last[~zero]])
        marked = order % sampled == 0
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.samples = order[marked]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol is among the last symbols before each place."""
        start = np.zeros_like(place)
        for bit, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            start = np.where(one, zeros[-1] + start - zeros[start], zeros[start])
            place = np.where(one, zeros[-1] + place - zeros[place], zeros[place])
        return place - start

    def symbol(self, place: np.ndarray) -> np.ndarray:
        found = np.zeros_like(place)
        for bit, zeros in self.levels:
            one = zeros[place + 1] == zeros[place]
            found |= one.astype(found.dtype) << bit
            place = np.where(one, zeros[-1] + place - zeros[place], zeros[place])
        return found

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and the end place of the suffixes that begin with each phrase."""
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.before[-1])
        for step in range(symbols.shape[1]):
            live = np.flatnonzero((lengths > step) & (low < high))
            c = symbols[live, lengths[live] - 1 - step]
            low[live] = self.before[c] + self.rank(c, low[live])
            high[live] = self.before[c] + self.rank(c, high[live])
        return low, high

    def locate(self, place: np.ndarray) -> np.ndarray:
        """The position of the suffix at each place."""
        position, walked = np.full(len(place), -1), 0
        left, place = np.arange(len(place)), place.copy()
        while len(left):
            here = self.marks[place + 1] > self.marks[place]
            position[left[here]] = self.samples[self.marks[place[here]]] + walked
            left, place = left[~here], place[~here]
            c = self.symbol(place)
            place = self.before[c] + self.rank(c, place)
            walked += 1
        return position


def occurrences(texts: Texts, phrases: Phrases) -> tuple:
    """The words of a shard, and (first word, phrase) of every place where a phrase stands."""
    words = texts.words(LETTERS, lower=True)
    none = words, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(phrases.lengths):
        return none
    hashes = words.hashes()
    at = np.minimum(np.searchsorted(phrases.hashes, hashes), len(phrases.hashes) - 1)
    symbol = np.where(phrases.hashes[at] == hashes, at + 1, 0)
    text_of = words.text_of()
    known = symbol > 0
    begins = known.copy()
    begins[1:] &= ~known[:-1] | (text_of[1:] != text_of[:-1])
    run = np.cumsum(begins) - 1
    sizes = np.bincount(run[known], minlength=run[-1] + 1 if len(run) else 0)
    kept = np.flatnonzero(known & (sizes[np.maximum(run, 0)] >= phrases.lengths.min())) if len(sizes) else none[1]
    if not len(kept):
        return none
    # runs with a separator between them, the largest symbol, and 0 at the end
    gap = np.concatenate([[0], np.cumsum(run[kept][1:] != run[kept][:-1])])
    separator = len(phrases.hashes) + 1
    sequence = np.full(len(kept) + gap[-1] + 1, separator)
    sequence[-1] = 0
    word_at = np.full(len(sequence), -1)
    sequence[np.arange(len(kept)) + gap] = symbol[kept]
    word_at[np.arange(len(kept)) + gap] = kept
    index = FmIndex(sequence, separator)
    low, high = index.search(phrases.symbols, phrases.lengths)
    counts = np.maximum(0, high - low)
    phrase = np.repeat(np.arange(len(low)), counts)
    places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    first = word_at[index.locate(places)]
    # symbols stand for hashes; the words themselves decide
    raw, starts, ends = words.data.tobytes(), words.starts, words.ends
    covered = np.unique(np.concatenate([first + i for i in range(phrases.symbols.shape[1])])) if len(first) else first
    covered = covered[covered < len(starts)]
    wrong = [w for w in covered.tolist() if symbol[w] and raw[starts[w] : ends[w]] != phrases.words[symbol[w] - 1]]
    if wrong:
        away = np.zeros(len(starts) + 1, np.int64)
        away[np.array(wrong) + 1] = 1
        away = np.cumsum(away)
        right = away[first + phrases.lengths[phrase]] == away[first]
        first, phrase = first[right], phrase[right]
    return words, first, phrase


def _covered(first: np.ndarray, lengths: np.ndarray, total: int) -> np.ndarray:
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def _pass(phrases, fields: list[str]):
    """Add the hits of a block to what earlier blocks have found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = phrases.value
        for batch in batches:
            for texts in chunks(batch):
                words, first, phrase = occurrences(texts, own)
                hit = _covered(first, own.lengths[phrase], len(words.starts))
                items: list[set[int]] = [set(x or ()) for x in texts.rows.column("items").to_pylist()]
                for text, p in set(zip((np.searchsorted(words.offsets, first, "right") - 1).tolist(), phrase.tolist())):
                    items[text].update(own.items[p])
                for i, spans in enumerate(texts.rows.column("spans").to_pylist()):
                    for a, b in spans or ():
                        hit[words.offsets[i] + a : words.offsets[i] + b] = True
                spans = []
                for i, (begin, end) in enumerate(zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist())):
                    edges = np.diff(np.concatenate([[0], hit[begin:end].astype(np.int8), [0]])) if hit[begin:end].any() else []
                    spans.append([[a, b] for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())] if len(edges) else [])
                clean = []
                raw = texts.data.tobytes()
                for i, found in enumerate(spans):
                    begin, parts = int(texts.offsets[i]), []
                    for a, b in found:
                        w = int(words.offsets[i])
                        parts.append(raw[begin : words.starts[w + a]])
                        begin = int(words.ends[w + b - 1])
                    clean.append(b"".join([*parts, raw[begin : texts.offsets[i + 1]]]).decode())
                done = {
                    "n_words": pa.array(words.counts().astype(np.int64)),
                    "items": pa.array([sorted(x) for x in items], pa.list_(pa.int64())),
                    "spans": pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                    "clean_text": pa.array(clean, pa.string()),
                }
                yield pa.RecordBatch.from_arrays(
                    [done[name] if name in done else texts.rows.column(name) for name in fields], names=fields
                )

    return run


def _found(docs: DataFrame, benchmark: DataFrame, block_bytes: int, carried: list[Column]) -> DataFrame:
    spark = docs.sparkSession
    let_workers_import(spark)
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    found = docs.select(
        *carried, "text", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("items"),
        F.array().cast("array<array<int>>").alias("spans"), F.lit("").alias("clean_text"),
    )
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).distinct().collect()
        phrases = spark.sparkContext.broadcast(phrases_of([(r[0], r[1]) for r in part]))
        found = found.mapInArrow(_pass(phrases, found.columns), found.schema)
        if block + 1 < blocks:
            found = written(found, "decontaminated")
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, text, n_words, items, spans, clean_text.

    items: ids of the items with a window in the text, ascending; spans: maximal runs of hit
    words as [first, end); clean_text: the text without them.  A NULL text has no words and
    an empty clean_text.  Items without words or with a NULL id find nothing; items that
    share an id count as one.  Rows that are repeated get a row each, empty tables give an empty result or find nothing, and texts of
    any length are searched whole.  Columns other than doc_id and text, item_id and text are not read, whatever their names.
    """
    return _found(docs, benchmark, block_bytes, [F.col("doc_id").cast("long").alias("doc_id")])


def clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the spans of test phrases taken out of text; all rows and other columns, whatever their names, stay."""
    found = _found(docs, benchmark, block_bytes, [as_row(docs, "text").alias("row")])
    hit = F.size("spans") > 0
    return with_text(found, docs.columns, F.when(hit, F.col("clean_text")).otherwise(F.col("text")), hit)
