from __future__ import annotations

import random
from pathlib import Path

import pytest

from topiclake.llm import lines
from topiclake.llm.tables import _CLEANUP, scratch, written
from topiclake.plans.workspace import shared_dir

DOCS = "doc_id long, text string, n_chars long, doc_key string, removed int"


def words(line):
    for blank in "\t\r\x0b\f":
        line = line.replace(blank, " ")
    return [w for w in line.split(" ") if w]


def tokens(line):
    w = words(line)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}


def brute(docs):
    """docs: (doc_id, text) with different ids."""
    every = [(d, i, tokens(x)) for d, t in sorted(docs, key=lambda d: (d[0] is None, d[0])) for i, x in enumerate((t or "").split("\n"))]
    gone = {(d, i) for at, (d, i, s) in enumerate(every) if s and any(100 * len(s & e) >= 75 * len(s | e) for _, _, e in every[:at] if e)}
    out = {}
    for d, t in docs:
        kept = [x for i, x in enumerate((t or "").split("\n")) if (d, i) not in gone]
        lost = any((d, i) in gone for i in range(len((t or "").split("\n"))))
        if not lost:
            out[d] = t
        elif any(map(words, kept)):
            out[d] = "\n".join(kept)
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(n)] for n in (5, 6, 12, 30, 60, 80)]
    docs = []
    for d in range(50):
        parts = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                line[rng.randrange(len(line))] = rng.choice([*vocabulary, f"x{rng.random()}"])
            parts.append(rng.choice([" ", "  ", "\t"]).join(line))
        docs.append((d, "\n".join([*parts, rng.choice(["", "short one", " short  one\t", "a b c d", "a b c", f"only {d}", "\u00a0"])])))
    return docs + [(50, None), (51, ""), (52, "\n\n"), (None, docs[4][1])]


@pytest.mark.parametrize("seed, short", [(1, lines.SHORT), (2, 2), (3, 2)])
def test_later_lines_go(spark, seed, short):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, len(t or ""), "k", 1) for d, t in docs], DOCS)
    got = lines.without_lines(df, lines.removed_lines(df, short)).collect()
    assert {r.doc_id: r.text for r in got} == brute(docs)
    assert all(r.n_chars == len(r.text or "") and r.doc_key == "k" and r.removed == 1 for r in got)


def test_repeated_rows_and_empty_tables(spark):
    line = "one two three four five six"
    df = spark.createDataFrame([(1, line), (1, line), (2, f"{line}\nkept"), (3, line)], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in lines.dedup_lines(df).collect())
    # rows that are equal in doc_id and text are one document
    assert got == [(1, line), (1, line), (2, "kept")]
    assert lines.dedup_lines(df.limit(0)).count() == 0
    assert lines.removed_lines(df.where("doc_id = 3")).count() == 0


def test_short_and_very_long_lines(spark):
    long = " ".join(f"w{i}" for i in range(100_000))
    docs = [(1, f"menu\n{long}\nhome page"), (2, f"menu\nhome\tpage \nown line"), (3, f"{long} more"), (4, " \n\t"), (5, "menu home page"), (6, "home page")]
    df = spark.createDataFrame([(d, t, len(t), "k", 1) for d, t in docs], DOCS)
    got = {r.doc_id: r.text for r in lines.dedup_lines(df).collect()}
    assert got == brute(docs) == {1: docs[0][1], 2: "own line", 4: " \n\t", 5: "menu home page"}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    plan = lines.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_only_the_result_stays_on_disk(spark):
    docs = [(d, t) for d, t in corpus(1) if d is not None]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before, setting = set(folder.glob("topiclake-*")), spark.conf.get(_CLEANUP, None)
    out = lines.dedup_lines(df)
    new = [p.name for p in set(folder.glob("topiclake-*")) - before]
    assert len(new) == 1 and new[0].startswith("topiclake-removed-")
    assert {r.doc_id: r.text for r in out.collect()} == brute(docs)
    assert spark.conf.get(_CLEANUP, None) == setting


def test_scratch_tables_go_when_it_fails(spark):
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("topiclake-*"))
    with pytest.raises(ZeroDivisionError), scratch(spark) as keep:
        kept = keep(spark.range(3), "kept")
        with scratch(spark) as inner:
            outer = inner(written(spark.range(5), "gone"), "outer")
        assert outer.count() == 5
        1 / 0
    assert [p.name.split("-")[1] for p in set(folder.glob("topiclake-*")) - before] == ["kept"] and kept.count() == 3


@pytest.mark.parametrize("seed, usual", [(1, 0), (2, 1), (3, 3), (4, 1000)])
def test_tokens_of_many_lines_come_last(spark, seed, usual):
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, len(t or ""), "k", 1) for d, t in docs], DOCS)
    removed = lines.removed_lines(df, 2, usual)
    got = lines.without_lines(df, removed).collect()
    assert {r.doc_id: r.text for r in got} == brute(docs)
    texts = {r.doc_key: (r.text or "").split("\n") for r in df.select("text", lines.row_key().alias("doc_key")).collect()}
    found = removed.collect()
    assert found and all(r.lost == sum(len(texts[r.doc_key][i]) for i in r.removed) for r in found)


def test_the_first_filter_shuffles_its_tokens_once(spark, monkeypatch):
    plans = []

    def watched(df, purpose):
        if purpose == "counted":
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return written(df, purpose)

    monkeypatch.setattr(lines, "written", watched)
    lines.removed_lines(spark.createDataFrame([(d, t) for d, t in corpus(1)], "doc_id long, text string"))
    assert len(plans) == lines._PASSES and all("ReusedExchange" in p for p in plans)
