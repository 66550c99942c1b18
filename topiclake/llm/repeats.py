"""Repeated passages by run-length indexes: every byte of a string of LENGTH bytes that
starts anywhere else too is removed.

* Every window of LENGTH bytes has an anchor: the leftmost of its GRAM-byte strings with the
  smallest hash.  Equal windows have equal anchors, so the windows of an anchor, which lie
  one after the other in a text (a segment, under 2 * LENGTH bytes), need to meet only segments
  with the same anchor.  An anchor that occurs once in the corpus has no repeated windows.
* Segments that are equal byte by byte are counted, not moved: all their windows are repeated.
* Different segments of an anchor go to a shard.  A shard is one sequence with separators.  Its
  Burrows-Wheeler transform is compressed to runs; suffix positions and match lengths are
  sampled at run ends only and streamed along the text: a match goes on for one byte less
  at the next byte, and only run ends begin longer ones.  Windows whose match
  is LENGTH bytes or longer are repeated.
* An anchor with more than HOT_BYTES of different segments does not fit a shard.  Its windows
  are counted one by one instead, by a hash of 128 bits, with the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from topiclake.llm.suffixes import suffix_order
from topiclake.llm.tables import let_workers_import, written
from topiclake.llm.words import BASE, Texts, chunks, mix
from topiclake.plans.bounded import small_side

LENGTH = 200
GRAM = 32
SHARD_BYTES = 1 << 20
HOT_BYTES = 16 << 20

_SEGMENTS = "row_key long, start int, size int, anchor long, segment long"
_SPANS = "array<struct<first:int,last:int>>"


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each position on; ``size`` is a power of two."""
    value, width = data.astype(np.uint64) + np.uint64(1), 1
    while width < size:
        value = value[:-width] * np.uint64(pow(int(BASE), width, 1 << 64)) + value[width:]
        width *= 2
    return mix(value)


def _sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of ``size`` values from each position on."""
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (size - width)], values[size - width :]) if size > width else values


def segments(texts: Texts, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, start, size, anchor's hash) of every segment; starts count from the text's begin."""
    n = len(texts.data)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty
    hashes = _gram_hashes(texts.data, gram)
    # the hash decides, then the position: 32 bits each
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_sliding_least(packed, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text_of = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))
    inside = text_of[: len(anchor)] == text_of[length - 1 :]
    window = np.flatnonzero(inside)
    anchor = anchor[window]
    if not len(window):
        return empty, empty, empty, empty
    new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(window) != 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    text = text_of[window[first]]
    return text, window[first] - texts.offsets[text], window[last] - window[first] + length, hashes[anchor[first]].view(np.int64)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch):
                text, start, size, anchor = segments(texts, length)
                raw = memoryview(texts.data.tobytes())
                begin = (start + texts.offsets[text]).tolist()
                name = np.fromiter((xxhash.xxh3_64_intdigest(raw[b : b + s]) for b, s in zip(begin, size.tolist())), np.uint64, len(begin))
                yield pa.RecordBatch.from_arrays(
                    [
                        texts.rows.column(0).take(pa.array(text)),
                        pa.array(start.astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                        pa.array(anchor),
                        pa.array(name.view(np.int64)),
                    ],
                    names=["row_key", "start", "size", "anchor", "segment"],
                )

    return run


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each text."""
    for batch in batches:
        for texts in chunks(batch):
            raw = texts.data.tobytes()
            rows, content = [], []
            for at, wanted in zip(texts.offsets.tolist(), texts.rows.column("wanted").to_pylist()):
                for w in wanted:
                    rows.append(w)
                    content.append(raw[at + w["start"] : at + w["start"] + w["size"]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w["anchor"] for w in rows], pa.int64()),
                    pa.array([w["segment"] for w in rows], pa.int64()),
                    pa.array([w["hot"] for w in rows], pa.bool_()),
                    pa.array(content, pa.binary()),
                ],
                names=["anchor", "segment", "hot", "content"],
            )


class RunIndex:
    """The runs of the Burrows-Wheeler transform of segments, sampled at both ends of each run."""

    def __init__(self, parts: list[bytes]):
        # symbols: 0 after every segment, bytes from 1
        sizes = np.array([len(p) + 1 for p in parts])
        self.ends = np.cumsum(sizes) - 1
        joined = np.frombuffer(b"\0".join([*parts, b""]), np.uint8).astype(np.uint64) + np.uint64(1)
        joined[self.ends] = 0
        self.n = n = len(joined)
        padded = np.concatenate([joined, np.zeros(7, np.uint64)])
        self.seven = np.zeros(n, np.uint64)
        for i in range(7):
            self.seven = (self.seven << np.uint64(9)) | padded[i : i + n]
        order = suffix_order(self.seven, 7, int(sizes.max()))
        before = joined[order - 1]
        change = before[1:] != before[:-1]
        heads, tails = np.append(True, change), np.append(change, True)
        # a segment's first byte continues no match
        begins = (order == 0) | (before == 0)
        heads |= begins
        tails |= begins
        up, down = np.flatnonzero(heads), np.flatnonzero(tails)
        self.runs = len(up)
        self.samples = [self._sampled(order, up, -1), self._sampled(order, down, 1)]

    def _sampled(self, order: np.ndarray, at: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of run ends and their match with the next suffix on that side."""
        beside = at + step
        inner = (beside >= 0) & (beside < self.n)
        position, other = order[at], order[np.clip(beside, 0, self.n - 1)]
        length = np.where(inner, self._match(position, other), 0)
        return position, length

    def _match(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The common prefix of the suffixes at ``a`` and ``b``, to the end of a segment at most."""
        length, live = np.zeros(len(a), np.int64), np.arange(len(a))
        room = self.ends[np.searchsorted(self.ends, a)] - a
        while len(live):
            x, y = a[live] + length[live], b[live] + length[live]
            ok = (x < self.n) & (y < self.n)
            same = np.zeros(len(live), bool)
            same[ok] = self.seven[x[ok]] == self.seven[y[ok]]
            part = ok & ~same
            if part.any():
                differ = self.seven[x[part]] ^ self.seven[y[part]]
                common = np.zeros(part.sum(), np.int64)
                for k in range(1, 8):
                    common += (differ >> np.uint64(63 - 9 * k)) == 0
                length[live[part]] += common
            length[live[same]] += 7
            live = live[same & (length[live] < room[live])]
        return np.minimum(length, room)

    def repeated(self, length: int) -> np.ndarray:
        """Whether the ``length`` bytes from each position on, in one segment, occur elsewhere."""
        reach = np.zeros(self.n, np.int64)
        for position, match in self.samples:
            reach[position] = np.maximum(reach[position], position + match)
        best = np.maximum.accumulate(reach) - np.arange(self.n)
        return best >= length


def _spans(flags: np.ndarray, length: int) -> list[dict]:
    """Runs of repeated windows as spans of bytes."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [{"first": a, "last": b - 1 + length} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]


def _index_shard(length: int):
    def run(shard: pa.Table) -> pa.Table:
        parts = shard["content"].to_pylist()
        index = RunIndex(parts)
        flags = index.repeated(length)
        begin = np.concatenate([[0], index.ends[:-1] + 1]).tolist()
        spans = [_spans(flags[b : b + len(p)], length) for b, p in zip(begin, parts)]
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        return pa.table({"anchor": shard["anchor"], "segment": shard["segment"], "spans": pa.array(spans, kind)})

    return run


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                some = batch.slice(at, 4096)
                row, first, name = [], [], []
                for i, content in enumerate(some.column("content").to_pylist()):
                    for x in range(len(content) - length + 1):
                        row.append(i)
                        first.append(x)
                        name.append(xxhash.xxh3_128_digest(content[x : x + length]))
                yield pa.RecordBatch.from_arrays(
                    [some.column("anchor").take(pa.array(row, pa.int64())), some.column("segment").take(pa.array(row, pa.int64())), pa.array(first, pa.int32()), pa.array(name, pa.binary())],
                    names=["anchor", "segment", "first", "name"],
                )

    return run


def _counted_windows(content: DataFrame, length: int) -> DataFrame:
    """Spans of the segments of hot anchors, from counts of their windows."""
    every = content.mapInArrow(_windows(length), "anchor long, segment long, first int, name binary")
    twice = every.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    span = F.struct("first", (F.col("first") + length).cast("int").alias("last"))
    return every.join(twice, "name", "left_semi").groupBy("anchor", "segment").agg(F.collect_list(span).alias("spans"))


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge spans and cut them out."""
    for batch in batches:
        for texts in chunks(batch):
            raw = texts.data.tobytes()
            spans, kept = [], []
            for begin, end, found in zip(texts.offsets.tolist(), texts.offsets[1:].tolist(), texts.rows.column("found").to_pylist()):
                merged: list[list[int]] = []
                for a, b in sorted((s["first"], s["last"]) for s in found or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                edges = [0, *(x for span in merged for x in span), end - begin]
                spans.append([{"first": a, "last": b} for a, b in merged])
                kept.append(b"".join(raw[begin + a : begin + b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [
                    texts.rows.column(0),
                    pa.array(np.diff(texts.offsets), pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                    pa.array(kept, pa.binary()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                ],
                names=["doc_id", "n_bytes", "spans", "kept", "kept_sha256"],
            )


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``docs`` (doc_id, text, any others) -> doc_id, n_bytes, spans, kept (bytes), kept_sha256.

    spans: maximal runs of removed bytes as [first, last).  Texts are UTF-8 bytes, a NULL text
    is empty; cuts may fall into a character, so what is kept is bytes.  Rows are documents of
    their own even when they share a doc_id; rows equal in doc_id and text are copies of each
    other.  An empty table gives an empty result.  ``length`` must be 64 bytes or more.  Texts of any length are cut
    whole into segments.  Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    let_workers_import(spark)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    text = text.select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", "text")
    every = written(text.select("row_key", "text").mapInArrow(_cut(length), _SEGMENTS), "segments")
    often = every.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    shared = written(every.join(often, "anchor"), "shared")
    place = F.min(F.struct("row_key", "start", "size")).alias("place")
    distinct = written(shared.groupBy("anchor", "segment").agg(F.count("*").alias("n"), place), "distinct")
    by_anchor = distinct.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("place.size").alias("bytes"))
    several = written(by_anchor.where("kinds > 1").withColumn("hot", F.col("bytes") > hot_bytes).select("anchor", "bytes", "hot"), "several")
    # segments that occur twice, whole
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("place.size").alias("last"))).cast(_SPANS)
    marks = distinct.where("n > 1").select("anchor", "segment", whole.alias("spans"))
    totals = {r["hot"]: r["bytes"] for r in several.groupBy("hot").agg(F.sum("bytes").alias("bytes")).collect()}
    if totals:
        wanted = distinct.join(several.select("anchor", "hot"), "anchor").select("anchor", "segment", "hot", "place.*")
        wanted = wanted.groupBy("row_key").agg(F.collect_list(F.struct("start", "size", "anchor", "segment", "hot")).alias("wanted"))
        wanted = written(wanted, "wanted")
        some = text.join(small_side(wanted.select("row_key")), "row_key", "left_semi").dropDuplicates(["row_key"])
        content = some.select("row_key", "text").join(wanted, "row_key").select("text", "wanted")
        content = written(content.mapInArrow(_contents, "anchor long, segment long, hot boolean, content binary"), "contents")
        shards = max(1, -(-totals.get(False, 0) // SHARD_BYTES))
        cold = content.where("not hot").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
        found = cold.groupBy("shard").applyInArrow(_index_shard(length), f"anchor long, segment long, spans {_SPANS}")
        if totals.get(True):
            found = found.unionByName(_counted_windows(content.where("hot"), length))
        once = distinct.where("n = 1").select("anchor", "segment")
        indexed = found.where(F.size("spans") > 0).join(once, ["anchor", "segment"], "left_semi")
        marks = marks.unionByName(indexed)
    marked = shared.join(written(marks, "marks"), ["anchor", "segment"])
    moved = F.transform("spans", lambda s: F.struct((s["first"] + F.col("start")).alias("first"), (s["last"] + F.col("start")).alias("last")))
    by_text = marked.select("row_key", moved.alias("found")).groupBy("row_key").agg(F.flatten(F.collect_set("found")).alias("found"))
    return text.join(by_text, "row_key", "left").select("doc_id", "text", "found").mapInArrow(
        _removed, f"doc_id long, n_bytes long, spans {_SPANS}, kept binary, kept_sha256 string"
    )
