from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

from topiclake.llm import licenses
from topiclake.llm.words import chunks

DOCS = "doc_id long, text string, score string"
FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_phrases_of_documents(spark):
    texts = dict(duckdb.execute(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall())
    got = licenses.scan(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def plain_scan(texts):
    """labels and score of each text by their meaning: every place of a key phrase, and the words in place around it."""
    found, split = licenses.templates(), {d: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for d, t in texts.items()}
    files = Counter(w for words in split.values() for w in set(words))
    rarity = {w: max(1e-9, math.log((len(split) + 2) / (files[w] + 1))) for t in found for w in t.words}
    out = {}
    for d, words in split.items():
        labels, best = set(), 0.0
        for t in found:
            first, end = t.key
            for at in (i - first for i in range(len(words)) if words[i : i + end - first] == t.words[first:end]):
                here = sum(rarity[w] for q, w in enumerate(t.words) if 0 <= at + q < len(words) and words[at + q] == w)
                share = 1.0 if t.base else min(1.0, here / sum(rarity[w] for w in t.words))
                if share >= licenses.LEAST_SHARE:
                    labels.add(t.label)
                    best = max(best, share)
        out[d] = (",".join(sorted(labels)), best)
    return out


def test_labels_and_scores_against_their_meaning(spark):
    rng = random.Random(4)
    pieces = [t for _, t, _ in [*licenses.NOTICES, *licenses.TEXTS]] + list(licenses.BASE)
    texts = {}
    for d in range(150):
        words = " ".join(rng.choice(pieces) if rng.random() < 0.6 else "some other words" for _ in range(rng.randint(0, 4))).split()
        for _ in range(rng.choice([0, 0, 1, 3, 10, 40])):
            if words:
                words[rng.randrange(len(words))] = rng.choice(["other", "", "the", "license", "software the"])
        texts[d] = " ".join(words[rng.randint(0, 8) :])
    texts |= {1000: None, 1001: "the " * 100_000 + licenses.TEXTS[0][1]}
    want = plain_scan(texts)
    got = licenses.scan(spark.createDataFrame([(d, t, "s") for d, t in texts.items()], DOCS).repartition(5)).collect()
    assert {r.doc_id: r.labels for r in got} == {d: labels for d, (labels, _) in want.items()}
    assert all(math.isclose(r.score, want[r.doc_id][1], rel_tol=1e-9, abs_tol=1e-12) for r in got)
    assert len({x for labels, _ in want.values() for x in labels.split(",")}) > 10


def test_rare_words_agree_on_where_a_template_stands(spark):
    """Without the places of key phrases the index alone finds licences that are whole."""
    index = licenses.Index(licenses.templates())
    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [f"x y {licenses.TEXTS[3][1]} z", "the software"]})
    (texts,) = chunks(rows)
    words = texts.words(licenses.LETTERS, lower=True)
    number, text_of = index.numbers_of(words.hashes()), words.text_of()
    rare = licenses._rarest(index, number, text_of, np.flatnonzero(number >= 0))
    zlib = next(i for i, t in enumerate(index.templates) if t.label == "zlib")
    agreed = licenses._agreed(zlib, index, rare, text_of)
    assert 2 in agreed.tolist() and licenses._stands(zlib, index, number, agreed).tolist() == [2]
    assert len({w for w, at in rare.items() if (text_of[at] == 0).any()}) == licenses.LOOKED_UP


def test_notices_and_odd_rows(spark):
    notices = {label: notice for label, notice, _ in licenses.NOTICES}
    changed = notices["mit"].replace("any person obtaining", "every person getting")
    no_key = notices["mit"].replace("free of charge", "free of any charge")
    values = [*notices.values(), changed, no_key, "CC-BY cc by, CC BY", None, "", "all rights", "rights reserved all", "cc", "by"]
    df = spark.createDataFrame([(i, v, "s") for i, v in enumerate(values)] + [(None, "cc by", "s"), (0, values[0], "s")], DOCS)
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    for i, label in enumerate(notices):
        assert label in got[i].labels.split(",") and got[i].score > 0.99
    n = len(notices)
    assert got[n].labels == "mit" and 0.6 <= got[n].score < 1
    assert got[n + 1].labels == ""
    for i, v in enumerate(values):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(v)
    assert got[None].base_labels == "cc-by"
    assert licenses.scan(df.limit(0)).count() == 0


def test_words_of_two_files_never_join(spark):
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(["all", "rights reserved", "general public", "license"])], DOCS).coalesce(1)
    assert [r.n_base for r in licenses.scan(df).collect()] == [0, 0, 0, 0]


def test_the_key_phrase_is_enough_to_look():
    # the first words are the rarest of this index, and three of the four are others
    notices = {label: notice for label, notice, _ in licenses.NOTICES}
    text = notices["apache-2.0"].replace("licensed under the", "made with another", 1)
    rows = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [f"before {text} after"]})
    (texts,) = chunks(rows)
    index = licenses.Index(licenses.templates())
    (got,) = licenses.scan_texts(texts, index).to_pylist()
    size = len(notices["apache-2.0"].split())
    assert got["labels"] == "apache-2.0" and got["score"] == (size - 3) / size
