from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from topiclake.llm import merkle
from topiclake.llm.queries.documents import op11_merkle_manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def leaf_of(row) -> str:
    doc, text, lang, source, chars = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, chars, text)))


def tree(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i : i + 3])) for i in range(0, len(low), 3)])
    return levels


def brute(rows):
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = [tree([leaf_of(r) for r in groups[s]]) for s in order]
    above = tree([t[-1][0] for t in trees])
    out = []
    for no, s in enumerate(order):
        for i, row in enumerate(groups[s]):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None
            node = leaf_of((row[0], row[1].replace("\n", ""), *row[2:])) if tampered else leaf_of(row)
            siblings = ""
            for levels, at in ((trees[no], i), (above, no)):
                for level in levels[:-1]:
                    run = level[at // 3 * 3 : at // 3 * 3 + 3]
                    place = at % 3
                    siblings += "".join(run[:place] + run[place + 1 :])
                    node = sha("".join([*run[:place], node, *run[place + 1 :]]))
                    at //= 3
            root = above[-1][0]
            out.append((row[0], leaf_of(row), trees[no][-1][0], root, sha(siblings), node, node == root))
    return sorted(out, key=str)


@pytest.fixture
def run(spark, path):
    def call(rows):
        folder = path("merkle")
        spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(f"{folder}/documents.parquet")
        return sorted((tuple(r) for r in op11_merkle_manifest(spark, folder).collect()), key=str)

    return call


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (3, 4, 81), (82, 1, 243, 2), (700, 1)])
def test_sizes(run, sizes):
    rows = [(s * 10_000 + i * 7, f"line {i}\nnext" if i % 3 else f"{i}", "en", f"s{s}", i) for s, n in enumerate(sizes) for i in range(n)]
    assert run(rows) == brute(rows)


def test_nulls_ties_repeats_and_long_texts(run):
    rows = [(None, None, None, None, None), (None, "a\n", None, None, None), (5, "", "", "", 0), (5, "", "", "", 0), (5, "b\nc", "é", "", None), (6, "\n" * 300_000, "de", "é", 300_000), (7, "ü\n", "de", "z", 2), (8, None, "de", "z", 2), (-1, "\n", "x", "z", 1)]
    rows += [(i, f"text {i % 3}\n", "en", f"many {i}", 1) for i in range(90)]
    rows += [(42, "same", "en", "copies", 4)] * 200
    assert run(rows) == brute(rows)


def test_nothing(run):
    assert run([]) == []


def test_any_columns(spark):
    rows = [(i % 4, f"k{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "node long, leaf string, at long").withColumn("map", F.create_map(F.lit("a"), "at"))
    found = merkle.prove(merkle.build(df, merkle.digest(F.col("leaf")), "node", ["leaf"], {"key": F.col("leaf"), "map": F.col("map")}))
    got = found.withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof"))).collect()
    assert len(got) == 100 and all(r.folded == r.root for r in got) and len({r.root for r in got}) == 1
    assert {r.leaf for r in got} == {sha(f"{len(k)}:{k}") for _, k, _ in rows}
    assert len({r.subroot for r in got}) == 4 and {r.map["a"] for r in got} == set(range(100))


def test_only_each_fourth_level_is_kept(spark):
    df = spark.range(1000).select("id", F.lit("one").alias("g"))
    manifest = merkle.build(df, merkle.digest(F.col("id")), "g", ["id"])
    assert [level.count() for level in manifest.levels] == [1000, 13, 1]
    assert merkle.regenerated([sha(str(i)) for i in range(81)], 1000)[-1] == [tree([sha(str(i)) for i in range(81)])[-1][0]]
    assert [len(level) for level in merkle.regenerated(["a"], 82)] == [1, 1, 1, 1, 1] and merkle.regenerated(["a"], 1) == [["a"]]
