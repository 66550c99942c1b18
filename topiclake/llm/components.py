"""Connected components of a graph given as a table of edges.

First every task joins the edges it has, up to EDGES_PER_TASK of them, into stars around the
smallest node; a graph that fits one task is then done.  Otherwise two steps alternate
until nothing changes: every node hands its smallest neighbour to its larger neighbours,
then to its smaller ones.  Edges end as stars around the smallest node of each component,
after about log(n) rounds.  Minima are pre-aggregated, the joins are plain equi-joins that
adaptive execution splits where a node is hot, and each round is written to the shared
folder, so that lineage stays short.  Only a count and a checksum reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topiclake.llm.tables import let_workers_import, written

EDGES_PER_TASK = 1_000_000


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace a task's edges by stars around the smallest node of what they connect."""
    above: dict = {}

    def top(node):
        path = []
        while (parent := above.get(node, node)) != node:
            path.append(node)
            node = parent
        for passed in path:
            above[passed] = node
        return node

    schema = None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = top(u), top(v)
            above[max(x, y)] = min(x, y)
    if schema is not None:
        nodes = list(above)
        rows = [(n, t) for n in nodes if (t := top(n)) != n]
        for at in range(0, len(rows), 50_000):
            some = rows[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in some], schema.field(i).type) for i in (0, 1)], schema=schema
            )


def _hand_down(edges: DataFrame, larger: bool) -> DataFrame:
    """``edges`` (u, v) with u > v.  Link neighbours of a node to its smallest neighbour."""
    if larger:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        linked = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return linked.where(F.col("u") > F.col("v")).distinct()


def connected(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Loops and repeated edges are allowed, rows with a NULL end are ignored, and an empty
    table gives an empty result.
    """
    state = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .distinct(),
        "edges",
    )
    let_workers_import(edges.sparkSession)
    tasks = -(-state.count() // edges_per_task)
    if tasks:
        state = written(state.repartition(tasks).mapInArrow(_stars, state.schema), "edges")
    before = None
    while tasks > 1:
        check = F.bit_xor(F.xxhash64("u", "v"))
        now = tuple(state.agg(F.count("*"), check).first())
        if now == before or not now[0]:
            break
        before = now
        state = written(_hand_down(_hand_down(state, larger=True), larger=False), "edges")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
