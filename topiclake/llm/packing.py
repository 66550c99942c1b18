"""Packing of documents into training sequences by dynamic programming, in the order of the input.

The ids of a partition's documents, each followed by END, are one stream.  Windows of at most
LENGTH ids are cut at ends of documents (free) or of sentences (a penalty); a sentence longer
than a window may be cut inside for a larger one.  Padding costs one an id, except in windows
whose length is a power of two.  With f the least cost up to a cut, f[i] is the least of
f[j] - (cut[i] - cut[j]) over the cuts at most LENGTH back, kept in a monotone queue, and of
the few cuts exactly a power of two back.

A partition is packed in blocks of about BLOCK ids; the last window of a block opens the
next one, so a block's end is not a cut.  Nothing is shuffled: partitions are the input's.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from topiclake.llm.tables import let_workers_import
from topiclake.llm.tokens import encoder
from topiclake.llm.words import chunks

LENGTH = 1024
END = 0
BLOCK = 1 << 20
#: costs in ids of padding: a cut after a sentence, inside a sentence, a window
SENTENCE, INSIDE, WINDOW = 4, 64, 1
#: the shortest window that is left without padding on purpose
SHORTEST = 64


def best_cuts(cuts: np.ndarray, penalties: np.ndarray, length: int = LENGTH) -> list[int]:
    """The chosen cuts, as numbers into ``cuts``; the first and the last are always chosen.

    ``cuts`` ascend and no two neighbours are further than ``length`` apart.
    """
    n = len(cuts)
    exact: list = [None] * n
    size = SHORTEST
    while size < length:
        at = np.searchsorted(cuts, cuts - size)
        for i in np.flatnonzero((cuts >= cuts[0] + size) & (cuts[np.minimum(at, n - 1)] == cuts - size)).tolist():
            exact[i] = [*(exact[i] or ()), int(at[i])]
        size *= 2
    place, penalty = cuts.tolist(), penalties.tolist()
    cost, back = [0] * n, [0] * n
    keys = [place[0]] + [0] * (n - 1)  # cost + place
    queue = deque([0])
    for i in range(1, n):
        p = place[i]
        while place[queue[0]] < p - length:
            queue.popleft()
        j = queue[0]
        found = keys[j] + length - p
        if exact[i]:
            for k in exact[i]:
                if cost[k] < found:
                    found, j = cost[k], k
        cost[i] = found = found + penalty[i] + WINDOW
        back[i] = j
        keys[i] = key = found + p
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(i)
    chosen = [n - 1]
    while chosen[-1]:
        chosen.append(back[chosen[-1]])
    return chosen[::-1]


def _with_inner(cuts: np.ndarray, penalties: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Add cuts inside of what is longer than a window."""
    gaps = np.diff(cuts)
    wide = np.flatnonzero(gaps > length)
    if not len(wide):
        return cuts, penalties
    inner = np.concatenate([np.arange(cuts[i] + length, cuts[i + 1], length) for i in wide])
    order = np.argsort(np.concatenate([cuts, inner]), kind="stable")
    return np.concatenate([cuts, inner])[order], np.concatenate([penalties, np.full(len(inner), INSIDE)])[order]


class Stream:
    """The open end of a partition: documents from the last cut on."""

    def __init__(self, length: int):
        self.length = length
        self.ids: list[np.ndarray] = []
        self.cuts, self.ends = [np.zeros(1, np.int64)], []  # places: possible cuts, ends of documents
        self.names: list = []
        self.begins: list[int] = []  # may lie before the open end
        self.sizes: list[int] = []
        self.total = 0
        self.windows = 0

    def add(self, name, ids: np.ndarray, breaks: np.ndarray) -> None:
        self.names.append(name)
        self.begins.append(self.total)
        self.sizes.append(len(ids) + 1)
        self.ids += [ids, np.full(1, END, np.uint32)]
        self.cuts.append(breaks[breaks < len(ids)] + self.total)
        self.total += len(ids) + 1
        self.ends.append(self.total)
        self.cuts.append(np.array([self.total]))

    def pack(self, last: bool) -> dict[str, list] | None:
        """Pieces of all windows, or of all but the last one, which stays open."""
        if not self.total:
            return None
        ids = np.concatenate(self.ids)
        cuts = np.unique(np.concatenate(self.cuts))
        penalties = np.where(np.isin(cuts, self.ends), 0, SENTENCE)
        cuts, penalties = _with_inner(cuts, penalties, self.length)
        chosen = cuts[best_cuts(cuts, penalties, self.length)]
        if not last:
            chosen = chosen[:-1]
        out: dict[str, list] = {k: [] for k in ("name", "start", "ids", "doc_tokens", "window", "offset")}
        stop = int(chosen[-1])
        begins = np.array(self.begins)
        edges = np.unique(np.concatenate([chosen, begins[(begins > 0) & (begins < stop)]]))
        doc = np.searchsorted(begins, edges[:-1], "right") - 1
        window = np.searchsorted(chosen, edges[:-1], "right") - 1
        raw = ids.astype("<u4").tobytes()
        for a, b, d, w in zip(edges[:-1].tolist(), edges[1:].tolist(), doc.tolist(), window.tolist()):
            out["name"].append(self.names[d])
            out["start"].append(a - self.begins[d])
            out["ids"].append(raw[4 * a : 4 * b])
            out["doc_tokens"].append(self.sizes[d])
            out["window"].append(self.windows + w)
            out["offset"].append(a - int(chosen[w]))
        self.windows += len(chosen) - 1
        keep = [i for i, (b, s) in enumerate(zip(self.begins, self.sizes)) if b + s > stop]
        self.names, self.sizes = [self.names[i] for i in keep], [self.sizes[i] for i in keep]
        self.begins = [self.begins[i] - stop for i in keep]
        self.ends = [b + s for b, s in zip(self.begins, self.sizes)]
        # cuts inside of sentences are found again
        known = np.unique(np.concatenate(self.cuts))
        self.cuts = [np.zeros(1, np.int64), known[known > stop] - stop]
        self.ids, self.total = [ids[stop:]], len(ids) - stop
        return out


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """``docs`` (doc_id, text, any others) -> a row for each piece: doc_id, start, length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``tokenizer``: path of a tokenizer file that all workers can read.  ``length`` is a power
    of two.  Order is that of the rows in each partition.  A NULL or empty text is END alone;
    rows that share a doc_id are packed one after the other like any others; an empty table
    gives no pieces.  Texts of any length are cut into as many pieces as they need; other columns are not read, whatever their names.
    sequence_id: the partition's number times 2^40, plus the window's.
    """
    let_workers_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, stream = encoder(tokenizer), Stream(length)
        base = TaskContext.get().partitionId() << 40

        def rows(found: dict[str, list] | None) -> Iterator[pa.RecordBatch]:
            if found:
                ids = pa.array(found["ids"], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found["name"], pa.int64()),
                        pa.array(found["start"], pa.int64()),
                        pa.array([len(i) // 4 for i in found["ids"]], pa.int64()),
                        ids,
                        pa.array(found["doc_tokens"], pa.int64()),
                        pa.array([base + w for w in found["window"]], pa.int64()),
                        pa.array(found["offset"], pa.int64()),
                    ],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

        for batch in batches:
            for texts in chunks(batch):
                names = texts.rows.column(0).to_pylist()
                for name, ids, breaks in zip(names, *own.encode(texts)):
                    stream.add(name, ids, breaks)
                if stream.total >= block:
                    yield from rows(stream.pack(last=False))
        yield from rows(stream.pack(last=True))

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return text.mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
