"""Very long texts and columns whose names operators use themselves."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from topiclake.llm import chat, decontaminate, licenses, lines, near_copies, packing, quality, repeats, urls, warc

CLASHING = "name check place line tokens token n first row row_key doc_key spans items kept text_of root host digest page_id is_first label url html words ids start".split()
LONG = [" ".join(f"w{i % 9973}x{i // 7}" for i in range(20_000)), "z" * 200_000, "a b " * 20_000, "line\n" * 5_000]


def odd(df):
    """The same rows with a column of each clashing name that it does not have."""
    return df.select("*", *[F.lit(c).alias(c) for c in CLASHING if c not in df.columns])


def documents(spark):
    rows = [(i, t) for i, t in enumerate(LONG)] + [(10, LONG[0][100:]), (11, "short"), (12, None)]
    return odd(spark.createDataFrame(rows, "doc_id long, text string"))


def test_documents(spark):
    docs = documents(spark)
    n = docs.count()
    found = {r.doc_id: r for r in near_copies.near_copies(docs).collect()}
    assert len(found) == n and found[10].component_id == 0 and found[1].n_shingles == 1
    kept = near_copies.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == n - 1
    deduped = lines.dedup_lines(docs)
    assert deduped.columns == docs.columns and {r.doc_id: r.text for r in deduped.select("doc_id", "text").collect()} == {**{i: t for i, t in enumerate(LONG)}, 3: "line\n", 11: "short", 12: None}
    assert repeats.remove_repeats(docs).count() == quality.judge(docs, None).count() == licenses.scan(docs).count() == n
    assert {r.doc_id: r.n_words for r in quality.judge(docs, None).collect()}[0] == 20_000
    assert quality.keep_good(docs, None).columns == docs.columns
    bench = odd(spark.createDataFrame([(7, " ".join(LONG[0].split()[-12:]))], "item_id long, text string"))
    hits = {r.doc_id: r.items for r in decontaminate.decontaminate(docs, bench).collect()}
    assert len(hits) == n and list(hits[0]) == list(hits[10]) == [7] and not hits[11]
    cleaned = decontaminate.clean(docs, bench)
    assert cleaned.columns == docs.columns and cleaned.count() == n
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert pieces.select("doc_id").distinct().count() == n


def test_pages_and_conversations(spark):
    pages = odd(spark.createDataFrame([(i, f"http://h/{i}" + "p" * 100_000, t) for i, t in enumerate(LONG)], "page_id long, url string, html string"))
    assert urls.judge(pages).count() == len(LONG)
    got = {r.page_id: r.payload.decode() for r in warc.round_trip(pages).collect()}
    assert got == dict(enumerate(LONG))
    turns = odd(spark.createDataFrame([(1, 0, "user", LONG[0]), (1, 1, "assistant", LONG[1]), (2, 0, None, LONG[2])], "conv_id long, turn long, role string, text string"))
    assert sum(LONG[0] in r.rendered for r in chat.repair(turns).collect()) == 1
