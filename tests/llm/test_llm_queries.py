"""Registered queries against their SQL, and the pipeline against what each stage is to do."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
import check
import corpus_pipeline
from topiclake.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    db = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, FOLDER)
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert {f.name: check.spark_kind(f.dataType.simpleString()) for f in df.schema.fields} == kinds
    assert check.rows_of(df.columns, [tuple(r) for r in df.collect()]) == check.rows_of(columns, cursor.fetchall())


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_module.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, path):
    """Each stage against a plain version over its own input."""
    import numpy as np
    from tokenizers import Tokenizer

    from tests.llm import test_decontaminate as dc, test_lines, test_near_copies as nc
    from topiclake.llm import quality

    db = duckdb.connect()
    bench = db.execute(f"select item_id, text from '{FOLDER}/benchmark.parquet'").fetchall()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in quality.judge(docs, model).collect() if r.kept}
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        target = path(name)
        stage(spark, docs, FOLDER).write.parquet(target)
        docs = spark.read.parquet(target)
        assert docs.columns == columns
        got = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality_rules":
            want = {d: t for d, t in texts.items() if d in good}
        elif name == "line_dedup":
            want = test_lines.brute(list(texts.items()))
        elif name == "near_copies":
            rows, _, sets = nc.brute(list(texts.items()))
            want = {r[0]: texts[r[0]] for r, s in zip(rows, sets) if r[3] or not s}
        else:
            assert got.keys() == texts.keys()
            for d, t in texts.items():
                _, hit, _ = dc.brute(t, bench)
                assert dc.words(got[d]) == [w for i, w in enumerate(dc.words(t)) if i not in hit]
            want = got
        assert got == want
        texts = got
    tokenizer = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    pieces: dict = {}
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    assert pieces.keys() == texts.keys()
    for d, t in texts.items():
        ids = np.frombuffer(b"".join(i for _, i in sorted(pieces[d])), "<u4").tolist()
        assert ids == [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]


def test_pipeline_of_nothing(spark, path):
    folder = path("empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
