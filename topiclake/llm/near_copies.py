"""Near-copies by bottom-k sketches of word shingles.

One hash function: a document keeps the KEPT smallest hashes of its distinct shingles.
Inverted lists of kept values give candidates, the sketch of the union estimates their
similarity, and the exact Jaccard similarity of the full sets decides.

* Documents with equal sets are one class from the start, so copies cost nothing later.
* The similar keep many values in common.  With J >= 0.75 the share of common kept values
  falls below COMMON = 0.375 with a probability of about 2e-9 (binomial tail, 64 values), and
  never when sets have no more than KEPT shingles.  So two similar classes share a value
  among the first ``len - ceil(COMMON * len) + 1`` kept values of each in one order, rarest
  first, and only these are listed.  Values that many documents share come last, so a
  passage that is everywhere lists only documents that consist of little else.
* A list is not turned into all its pairs.  In each round every list names one centre and
  the members of other components are compared with it; copies fall into one component.
* What is left between different components after ROUNDS rounds is compared exactly: lists of
  up to SHORT members pair by pair; the members of longer ones are dealt into blocks of about
  BLOCK, every two blocks that share a list meet once, and a task answers with the links that
  join its components, never more than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from topiclake.llm.components import connected
from topiclake.llm.tables import as_row, counted_side, let_workers_import, row_key, scratch, written
from topiclake.llm.words import Texts, chunks, mix, windows

SHINGLE = 5
KEPT = 64
COMMON = 0.375
#: six standard deviations of the estimate below 0.75
ESTIMATE = 0.42
ROUNDS = 2
SHORT, BLOCK = 32, 256
LINK, OF = 75, 100

_SKETCHES = "row_key long, doc_id long, n_shingles long, set_id binary, sketch array<long>"
_SETS = "set_id binary, members array<long>"


def shingle_sets(texts: Texts, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = texts.words(lower=True)
    hashes = words.hashes()
    whole = windows(hashes, size)
    for begin, end in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        if end - begin >= size:
            yield np.unique(whole[begin : end - size + 1].view(np.int64))
        elif end > begin:
            yield mix(windows(hashes[begin:end], end - begin) + np.uint64(end - begin)).view(np.int64)
        else:
            yield np.zeros(0, np.int64)


def _set_id(members: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(members.tobytes())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.concatenate(arrays) if arrays else np.zeros(0, np.int64))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in chunks(batch):
            sets = list(shingle_sets(texts))
            yield pa.RecordBatch.from_arrays(
                [
                    texts.rows.column(0),
                    texts.rows.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_id(s) for s in sets], pa.binary()),
                    _lists([s[:KEPT] for s in sets]),
                ],
                names=["row_key", "doc_id", "n_shingles", "set_id", "sketch"],
            )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in chunks(batch):
            sets = list(shingle_sets(texts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_id(s) for s in sets], pa.binary()), _lists(sets)], names=["set_id", "members"]
            )


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep (a, b) whose member lists of 64-bit hashes reach the similarity."""
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        keep = np.zeros(len(batch), bool)
        for i in range(len(batch)):
            x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = OF * common >= LINK * (len(x) + len(y) - common)
        yield batch.select([0, 1]).filter(pa.array(keep))


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep (a, b) whose union sketch does not rule out the similarity."""
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        keep = np.zeros(len(batch), bool)
        for i in range(len(batch)):
            x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
            union = np.union1d(x, y)[:KEPT]
            common = len(np.intersect1d(np.intersect1d(x, y, assume_unique=True), union, assume_unique=True))
            keep[i] = common >= ESTIMATE * len(union)
        yield batch.select([0, 1]).filter(pa.array(keep))


def _with_both(pairs: DataFrame, of: DataFrame, column: str) -> DataFrame:
    left = of.select(F.col("set_id").alias("a"), F.col(column).alias("left"))
    right = of.select(F.col("set_id").alias("b"), F.col(column).alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")


def _postings(classes: DataFrame) -> DataFrame:
    """(value, set_id, n_shingles): the listed values of each class, rarest first, that another class has too."""
    kept = classes.select("set_id", "n_shingles", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    # written, so that the join has plain sides and a hot value can be split
    often = written(kept.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "often")
    shared = kept.join(often, "value")
    by_class = Window.partitionBy("set_id")
    rank = F.row_number().over(by_class.orderBy("df", "value"))
    listed = F.col("k") - F.ceil(F.col("k") * COMMON) + 1
    return (
        shared.withColumn("rank", rank)
        .withColumn("alone", F.col("k") - F.count("*").over(by_class))
        .where(F.col("alone") + F.col("rank") <= listed)
        .select("value", "set_id", "n_shingles")
    )


def _pair(left: str, right: str) -> list:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _sizes_allow(x: str, y: str):
    return OF * F.least(x, y) >= LINK * F.greatest(x, y)


def _star_pairs(listed: DataFrame, turn: int) -> DataFrame:
    """Every member of a list with the list's centre of this round."""
    order = F.xxhash64("set_id", F.lit(turn))
    centre = F.min_by(F.struct("set_id", "n_shingles", "root"), order)
    centres = listed.groupBy("value").agg(centre.alias("c"), F.count("*").alias("n")).where("n > 1")
    centres = centres.select("value", F.col("c.set_id").alias("c"), F.col("c.n_shingles").alias("c_n"), F.col("c.root").alias("c_root"))
    near = listed.join(centres, "value").where((F.col("root") != F.col("c_root")) & _sizes_allow("n_shingles", "c_n"))
    return near.select(*_pair("set_id", "c")).distinct()


def _mixed(listed: DataFrame) -> DataFrame:
    """(value, n) of the lists whose members are in different components."""
    roots = listed.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    return roots.where("low != high").select("value", "n")


def _short_pairs(listed: DataFrame, mixed: DataFrame, short: int) -> DataFrame:
    left = listed.join(mixed.where(F.col("n") <= short).select("value"), "value", "left_semi")
    right = left.select("value", F.col("set_id").alias("c"), F.col("n_shingles").alias("c_n"), F.col("root").alias("c_root"))
    apart = (F.col("set_id") < F.col("c")) & (F.col("root") != F.col("c_root")) & _sizes_allow("n_shingles", "c_n")
    return left.join(right, "value").where(apart).select(*_pair("set_id", "c")).distinct()


def _blocks(listed: DataFrame, mixed: DataFrame, short: int, size: int) -> tuple[DataFrame, DataFrame]:
    """Members of long lists in blocks, (set_id, root, block), and the pairs of blocks that share a list."""
    hot = listed.join(mixed.where(F.col("n") > short), "value")
    anchor = F.max_by("value", F.struct("n", "value"))
    homes = hot.groupBy("set_id", "root").agg(anchor.alias("anchor"))
    sizes = homes.groupBy("anchor").agg(F.ceil(F.count("*") / size).alias("blocks"))
    block = F.xxhash64("anchor", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
    dealt = written(homes.join(sizes, "anchor").select("set_id", "root", block.alias("block")), "blocks")
    low, high = F.min("root").alias("low"), F.max("root").alias("high")
    present = hot.select("value", "set_id").join(dealt, "set_id").groupBy("value", "block").agg(low, high)
    other = present.select("value", F.col("block").alias("other"), F.col("low").alias("o_low"), F.col("high").alias("o_high"))
    # two blocks of one and the same component have nothing to join
    apart = (F.least("low", "o_low") != F.greatest("high", "o_high")) & (F.col("block") <= F.col("other"))
    return dealt, written(present.join(other, "value").where(apart).select("block", "other").distinct(), "meetings")


def _meet(rows: pa.Table) -> pa.Table:
    """The links between the two blocks of a group that join components, by exact similarity."""
    ids, roots, sides = (rows[c].to_pylist() for c in ("set_id", "root", "side"))
    column = rows["members"].combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    shingle, number = np.unique(column.flatten().to_numpy(), return_inverse=True)
    of = np.repeat(np.arange(len(ids)), lengths)
    # rows by shingle: who has it; pairs are counted per shingle against the members of each row
    order = np.argsort(number, kind="stable")
    ends = np.cumsum(np.bincount(number, minlength=len(shingle)))
    begins = np.append(0, ends[:-1])
    holder, begin = of[order], np.append(0, np.cumsum(lengths))
    side = np.array(sides)
    one_block = (side == 2).all()
    above = {r: r for r in roots}

    def top(r):
        while above[r] != r:
            above[r] = above[above[r]]
            r = above[r]
        return r

    links = []
    for x in range(len(ids)):
        if side[x] == 1:
            continue
        mine = number[begin[x] : begin[x + 1]]
        spans = [holder[begins[m] : ends[m]] for m in mine]
        common = np.bincount(np.concatenate(spans), minlength=len(ids)) if spans else np.zeros(len(ids), int)
        similar = OF * common >= LINK * (lengths[x] + lengths - common)
        similar &= np.arange(len(ids)) > x if one_block else side == 1
        for y in np.flatnonzero(similar).tolist():
            if top(roots[x]) != top(roots[y]):
                above[top(roots[x])] = top(roots[y])
                links.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})


def _block_links(listed: DataFrame, mixed: DataFrame, classes: DataFrame, text: DataFrame, short: int, size: int) -> DataFrame:
    dealt, meetings = _blocks(listed, mixed, short, size)
    sets = _sets_of(dealt.select("set_id"), classes, text)
    home = dealt.join(sets, "set_id")
    same = F.when(F.col("block") == F.col("other"), 2)
    first = meetings.withColumn("side", same.otherwise(0))
    second = meetings.where("block != other").withColumn("side", F.lit(1))
    there = first.join(home, "block").select("block", "other", "side", "set_id", "root", "members")
    more = second.join(home.withColumnRenamed("block", "other"), "other")
    both = there.unionByName(more.select("block", "other", "side", "set_id", "root", "members"))
    return both.groupBy("block", "other").applyInArrow(_meet, "a binary, b binary")


def _grouped(docs: DataFrame, short: int, block: int) -> DataFrame:
    """row_key, doc_id, n_shingles, root (the group; NULL without shingles) and component_id of each row."""
    spark = docs.sparkSession
    let_workers_import(spark)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    keyed = text.select(row_key().alias("row_key"), "doc_id", "text")
    sketches = written(keyed.mapInArrow(_sketch, _SKETCHES), "sketches")
    with_any = sketches.where("n_shingles > 0")
    classes = written(
        with_any.groupBy("set_id").agg(
            F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch")
        ),
        "classes",
    )
    postings = written(_postings(classes), "postings")
    links, tried, roots = None, None, None
    for turn in range(ROUNDS + 1):
        listed = postings.withColumn("root", F.col("set_id"))
        if roots is not None:
            known = roots.select(F.col("node").alias("set_id"), "root")
            listed = postings.join(known, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
        if turn < ROUNDS:
            pairs = _star_pairs(listed, turn)
        else:
            listed = written(listed, "listed")
            mixed = written(_mixed(listed), "mixed")
            pairs = _short_pairs(listed, mixed, short)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        new = None
        if not pairs.isEmpty():
            tried = pairs if tried is None else tried.unionByName(pairs)
            likely = written(_with_both(pairs, classes, "sketch").mapInArrow(_likely, "a binary, b binary"), "likely")
            new = _verified(likely, classes, text)
        if turn == ROUNDS and not mixed.where(F.col("n") > short).isEmpty():
            more = _block_links(listed, mixed, classes, text, short, block)
            new = more if new is None else new.unionByName(more)
        if new is None:
            continue
        new = written(new, "links")
        links = new if links is None else links.unionByName(new)
        if not new.isEmpty():
            roots = written(connected(links), "roots")
    return _labelled(sketches, classes, roots)


def _sets_of(wanted: DataFrame, classes: DataFrame, text: DataFrame) -> DataFrame:
    """(set_id, members) of the wanted classes, made again from the text of one document of each."""
    ids = classes.join(wanted, "set_id", "left_semi").select(F.col("first_id").alias("wanted")).distinct()
    some = text.join(counted_side(written(ids, "ids")), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    sets = some.mapInArrow(_members, _SETS).join(wanted, "set_id", "left_semi")
    return written(sets.dropDuplicates(["set_id"]), "sets")


def _verified(likely: DataFrame, classes: DataFrame, text: DataFrame) -> DataFrame:
    """The pairs of classes whose full shingle sets are similar."""
    ends = likely.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    return _with_both(likely, _sets_of(ends, classes, text), "members").mapInArrow(_overlaps, "a binary, b binary")


def _labelled(sketches: DataFrame, classes: DataFrame, roots: DataFrame | None) -> DataFrame:
    member = classes.select("set_id", "first_id", F.col("set_id").alias("root"))
    if roots is not None:
        known = roots.select(F.col("node").alias("set_id"), F.col("root").alias("found"))
        member = member.join(known, "set_id", "left").withColumn("root", F.coalesce("found", "root"))
    least = member.groupBy("root").agg(F.min("first_id").alias("component"))
    named = member.join(least, "root").select("set_id", "root", "component")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return sketches.join(named, "set_id", "left").select("row_key", "doc_id", "n_shingles", "root", component.alias("component_id"))


def near_copies(docs: DataFrame, short: int = SHORT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id, n_shingles,
    component_id (the smallest doc_id among all documents reachable over links), kept.

    Shingles are SHINGLE words, lower case A-Z; a document of fewer words is one shingle, one
    without words or with NULL text has none and is linked with nothing.  Rows that share a
    doc_id are documents of their own with the same name.  A NULL doc_id stays NULL: such a
    row takes the component's smallest known doc_id and is kept only if there is none.
    An empty table gives an empty result; columns other than doc_id and text are not read, whatever their names.  Texts of any length
    give all their shingles.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return _grouped(docs, short, block).select("doc_id", "n_shingles", "component_id", kept)


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of near-copies, with all its columns: that with the smallest doc_id,
    of several that with the smallest hash of doc_id and text.  Rows without words all stay; of rows that are equal in
    doc_id and text one stays."""
    with scratch(docs.sparkSession) as keep:
        grouped = keep(_grouped(docs, SHORT, BLOCK).where("root is not null").select("row_key", "doc_id", "root"), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    first = grouped.groupBy("root").agg(F.min(order).alias("first")).select("root", F.col("first.row_key").alias("first"))
    by_key = grouped.groupBy("row_key", "root").agg(F.count("*").alias("n")).join(first, "root")
    # keys of rows that go, and of rows that are there more than once, equal in doc_id and text
    going = by_key.where("row_key <> first or n > 1").select("row_key", (F.col("row_key") == F.col("first")).alias("again"))
    marked = docs.select(as_row(docs).alias("row"), row_key().alias("row_key")).join(counted_side(written(going, "going")), "row_key", "left")
    once = marked.where("again").dropDuplicates(["row_key"])
    kept = marked.where("again is null").unionByName(once)
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
