"""Merkle manifest of a dataset: every row a leaf, a tree for each group, a tree over the groups.

Of every tree only each fourth level is kept (``STRIDE``): the leaves, then one node for 81 of them, one
for 81 of those, and so on.  A proof needs the levels between, so the nodes below one kept node, an aligned
subtree of at most 81, are hashed again when proofs are made, give the siblings, and are forgotten.

Leaves are numbered without bringing a group to one task: rows are sorted by ranges, their place in their
range is the place in the sorted partition, and a table of runs (range, group, rows) says what comes before.
A kept level is one shuffle by aligned subtree, so a group of any size is spread over all tasks.  Every level is
written, so a lost executor loses no level, and the number of levels follows from the largest group.

Proofs come from the top: the proof of a kept node goes on to the 81 below it, so that whole proofs are put
together once, at the leaves.  ``prove`` returns them; nothing writes them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from topiclake.llm.tables import counted_side, let_workers_import, written

#: children of a node
ARITY = 3
#: every so many levels one is kept
STRIDE = 4
#: nodes of a kept level below one node of the next
FAN = ARITY**STRIDE
#: aligned subtrees whose proofs are made at once in a task, about 3 MB
SUBTREES = 16
PROOF = "array<struct<left: string, right: string>>"


def digest(*columns: Column) -> Column:
    """Hex SHA-256 of the values, each ``-`` if NULL, else its UTF-8 bytes counted, ``:`` and itself."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest leads to by a proof."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """Hex SHA-256 of all siblings of a proof in order."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """``levels`` are the kept levels of the trees of all groups, rows (tree, n, at, node), with the carried
    columns as ``row`` in the first; ``above`` those of the tree over the groups; ``root`` is its root, None
    of an empty table."""

    levels: list[DataFrame]
    above: list[DataFrame]
    root: str | None


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_first``, the place in their sorted range (``_mid``) and its number (``_range``), and the runs
    (``_range``, group, ``first``, ``before``, ``n``): a row's number in its group is ``_mid - first + before``."""
    keys = [*[F.col(f"`{g}`").asc_nulls_first() for g in group], *[F.col(f"`{o}`").asc_nulls_first() for o in order]]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
    placed = written(placed.withColumn("_range", F.shiftright("_mid", 33)), "merkle-sorted")
    runs = placed.groupBy("_range", *group).agg(F.min("_mid").alias("first"), F.count("*").alias("size"))
    # a group has one run in a range, so these windows have no more rows than there are ranges
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_range", *group, "first", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"), F.sum("size").over(whole).alias("n")
    )
    return placed, written(runs, "merkle-runs")


def _leaves(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(tree, n, at, node, row) of all rows, and the groups (tree, n)."""
    placed, runs = numbered(rows, [group], order)
    sizes = runs.groupBy(group).agg(F.max("n").alias("n"))
    groups, ranges = numbered(sizes, [], [group])
    joined = groups.join(F.broadcast(ranges.select("_range", "first", "before")), "_range")  # a row for each range
    trees = written(joined.select(group, "n", (F.col("_mid") - F.col("first") + F.col("before")).alias("tree")), "merkle-trees")
    named = runs.join(counted_side(trees.select(F.col(group).alias("_named"), "tree")), runs[group].eqNullSafe(F.col("_named")))
    named = written(named.drop("_named"), "merkle-named")
    side = counted_side(named.select(F.col("_range").alias("_r"), F.col(group).alias("_g"), "first", "before", "n", "tree"))
    found = placed.join(side, (F.col("_range") == F.col("_r")) & placed[group].eqNullSafe(F.col("_g")))
    return found.select("tree", "n", (F.col("_mid") - F.col("first") + F.col("before")).alias("at"), F.col("leaf").alias("node"), "row"), trees


def build(rows: DataFrame, leaf: Column, group: str, order: list[str], carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``rows``: a tree for each value of ``group`` (NULL is one, the first), whose leaves, hex
    digests, ascend by ``order`` (NULL first) and then by digest, and a tree over the groups in their order.

    ``carry`` are columns that ``prove`` returns beside the proof.  Equal rows are leaves of their own, next to each
    other.  Texts of any length are hashed whole and stay where they are: only digests move.  Columns that are not
    named are not looked at, whatever their names.  An empty table has no trees and the root None.
    """
    let_workers_import(rows.sparkSession)
    names = [f"_o{i}" for i in range(len(order))]
    row = F.struct(*[c.alias(k) for k, c in (carry or {"leaf": leaf}).items()])
    made = written(
        rows.select(F.col(f"`{group}`").alias("_group"), *[F.col(f"`{o}`").alias(n) for o, n in zip(order, names)], leaf.alias("leaf"), row.alias("row")),
        "merkle-leaves",
    )
    # rows with one key and digest may be many; the last key lets ranges cut between them
    leaves, trees = _leaves(made.withColumn("_tie", F.monotonically_increasing_id()), "_group", [*names, "leaf", "_tie"])
    size = trees.agg(F.max("n").alias("n"), F.count("*").alias("trees")).first()
    if not size["trees"]:
        return Manifest([leaves], [], None)
    levels = _grow(leaves, size["n"])
    above = _grow(_tops(levels).select(F.lit(0).cast("long").alias("tree"), F.lit(size["trees"]).cast("long").alias("n"), F.col("tree").alias("at"), "node"), size["trees"])
    return Manifest(levels, above, above[-1].where("n = 1").first()["node"])


def _tops(levels: list[DataFrame]) -> DataFrame:
    """The root of each tree: it is in the level in which it stands alone."""
    return reduce(DataFrame.unionByName, [level.where("n = 1").select("tree", "node") for level in levels])


def _grow(leaves: DataFrame, largest: int) -> list[DataFrame]:
    """The kept levels above ``leaves``, as far as the largest tree goes."""
    levels = [leaves]
    while largest > 1:
        members = F.sort_array(F.collect_list(F.struct("at", "node")))
        blocks = levels[-1].where("n > 1").groupBy("tree", "n", F.expr(f"at DIV {FAN}").alias("block")).agg(members.alias("members"))
        above = blocks.select(
            "tree", F.ceil(F.col("n") / FAN).alias("n"), F.col("block").alias("at"), _top(F.col("members.node"), F.col("n")).alias("node")
        )
        levels.append(written(above, "merkle-level"))
        largest = -(-largest // FAN)
    return levels


def regenerated(nodes: list[str], n: int) -> list[list[str]]:
    """The levels of an aligned subtree from its lowest, in a level of ``n`` nodes: four more, or up to the root."""
    levels = [nodes]
    while len(levels) <= STRIDE if n > FAN else len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([hashlib.sha256("".join(low[i : i + ARITY]).encode()).hexdigest() for i in range(0, len(low), ARITY)])
    return levels


@pandas_udf(T.StringType())
def _top(nodes, n):
    """The node above an aligned subtree."""
    return nodes.combine(n, lambda members, size: regenerated(list(members), size)[-1][0])


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtrees with the proof of the node above them -> their lowest nodes with theirs."""
    for batch in batches:
        for begin in range(0, len(batch), SUBTREES):
            part = batch.slice(begin, SUBTREES)
            sizes = np.asarray(part.column("members").value_lengths())
            block = np.repeat(np.arange(len(part)), sizes)
            flat = part.column("members").flatten()
            flat = flat.take(pa.array(np.lexsort((np.asarray(flat.field("at")), block))))
            nodes, left, right, ends = flat.field("node").to_pylist(), [], [], [0]
            of = 0
            for size, n, upper in zip(sizes.tolist(), part.column("n").to_pylist(), part.column("proof").to_pylist()):
                levels = regenerated(nodes[of : of + size], n)
                of += size
                rest_left, rest_right = [s["left"] for s in upper], [s["right"] for s in upper]
                for i in range(size):
                    for level in levels[:-1]:
                        run = i - i % ARITY
                        left.append("".join(level[run:i]))
                        right.append("".join(level[i + 1 : run + ARITY]))
                        i //= ARITY
                    left += rest_left
                    right += rest_right
                    ends.append(len(left))
            steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
            proof = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)
            columns = [part.column(c).take(pa.array(block)) for c in ("tree", "subroot")]
            fields = {"tree": columns[0], "subroot": columns[1], **{f.name: flat.field(f.name) for f in flat.type}, "proof": proof}
            yield pa.RecordBatch.from_arrays(list(fields.values()), list(fields))


def _down(level: DataFrame, upper: DataFrame) -> DataFrame:
    """Proofs of the nodes of a level from those of the level above; ``upper`` is (tree, at, subroot, proof)."""
    members = [c for c in level.columns if c not in ("tree", "n")]
    kinds = ", ".join(f"{c} {level.schema[c].dataType.simpleString()}" for c in members)
    blocks = level.groupBy("tree", "n", F.expr(f"at DIV {FAN}").alias("_at")).agg(F.collect_list(F.struct(*members)).alias("members"))
    side = upper.select(F.col("tree").alias("_tree"), F.col("at").alias("_block"), "subroot", "proof")
    blocks = blocks.join(side, (F.col("tree") == F.col("_tree")) & (F.col("_at") == F.col("_block"))).drop("_tree", "_block")
    return blocks.mapInArrow(_proofs, f"tree bigint, subroot string, {kinds}, proof {PROOF}")


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Proofs of the lowest level; ``tops`` are (tree, subroot, proof) of the roots of the trees."""
    paths: DataFrame | None = None
    for k in range(len(levels) - 1, -1, -1):
        alone = levels[k].where("n = 1").select("tree", "at").join(tops, "tree")
        if k:
            known = alone.select("tree", "at", "subroot", "proof")
            paths = known if paths is None else known.unionByName(_down(levels[k].where("n > 1"), paths).select("tree", "at", "subroot", "proof"))
            paths = written(paths, "merkle-paths")
    # the one leaf of a tree is its root: a subtree without levels
    lone = alone.select("tree", "at", "subroot", "proof")
    return _down(levels[0], lone if paths is None else lone.unionByName(paths))


def prove(manifest: Manifest) -> DataFrame:
    """Each leaf's proof: its carried columns, ``leaf``, ``subroot``, ``root`` and ``proof``.

    ``proof`` has a step for each level, from the leaf to the root of all, with the digests of the siblings that stand
    before (``left``) and after (``right``), concatenated, empty where there are none.
    """
    carried = [F.col(f"row.{c}") for c in manifest.levels[0].schema["row"].dataType.names]
    none = F.array().cast(PROOF).alias("proof")
    if manifest.root is None:
        return manifest.levels[0].select(*carried, F.col("node").alias("leaf"), F.lit("").alias("subroot"), F.lit("").alias("root"), none)
    whole = manifest.levels[0].sparkSession.range(1).select(F.col("id").alias("tree"), F.lit(manifest.root).alias("subroot"), none)
    groups = _descend(manifest.above, whole)
    tops = written(groups.select(F.col("at").alias("tree"), F.col("node").alias("subroot"), "proof"), "merkle-subroots")
    found = _descend(manifest.levels, tops)
    return found.select(*carried, F.col("node").alias("leaf"), "subroot", F.lit(manifest.root).alias("root"), "proof")
