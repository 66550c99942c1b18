"""License scan: a positional index of rare licence words.

Templates are phrases, notices and whole licences as word sequences.  The index has a posting for every place of a
licence word in a template.  Words are ranked by their inverse document frequency over
all documents.  Of each file the rarest licence words are looked up: a place in the file less the place in the template
is an offset, and offsets on which several of the file's rare words agree are candidates, next to those at which
a template's key phrase stands.  At a candidate the key phrase must stand word by word, whatever the words around it
are, and the score is the share of the template's words in place, weighted
by their rarity.  A base phrase is a template that is all key, so all its places are found.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topiclake.llm.tables import let_workers_import
from topiclake.llm.words import LETTERS, Texts, chunks

#: share of a notice, weighted by rarity, that makes its label
LEAST_SHARE = 0.6
#: rarest licence words of a file that are looked up, and how many places of a template must agree on an offset
LOOKED_UP = 12
AGREE = 2

# fixed values: base phrases and their labels
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# fixed values: label, notice, key phrase in it
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-sa", "licensed under a creative commons attribution share alike license", "creative commons attribution share alike"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
]


# fixed values: label, whole licence, key phrase in it
TEXTS = [
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
        OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
        FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "this permission notice shall be included in all copies",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS
        ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
        AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA
        OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
        "this permission notice appear in all copies",
    ),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
        are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
        the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
        CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
        INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
        STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
        POSSIBILITY OF SUCH DAMAGE.""",
        "must retain the above copyright notice this list of conditions",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
        arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not
        be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in
        the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must
        not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.""",
        "the origin of this software must not be misrepresented",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
        distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
        means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
        the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
        successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
        under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
        WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "free and unencumbered software released into the public domain",
    ),
]


@dataclass
class Template:
    label: str
    words: list[str]
    key: tuple[int, int]  # where the key phrase stands in the words, as [first, end)
    base: bool


def template(label: str, text: str, key: str | None = None) -> Template:
    """A text and the phrase in it that must stand word by word, all of it unless given."""
    words = re.findall("[0-9a-z]+", text.lower())
    needed = words if key is None else key.split()
    at = next(i for i in range(len(words)) if words[i : i + len(needed)] == needed)
    return Template(label, words, (at, at + len(needed)), key is None)


def templates() -> list[Template]:
    return [template(label, phrase) for phrase, label in BASE.items()] + [template(*t) for t in [*NOTICES, *TEXTS]]


class Index:
    """Licence words by hash, and their postings: for each template, where each word stands."""

    def __init__(self, found: list[Template]):
        self.templates = found
        self.words = sorted({w for t in found for w in t.words})
        rows = pa.RecordBatch.from_pydict({"text": [" ".join(self.words)]})
        hashes = next(chunks(rows)).words(LETTERS).hashes()
        order = np.argsort(hashes)
        self.hashes, self.number_at = hashes[order], order
        number = {w: i for i, w in enumerate(self.words)}
        self.numbers = [np.array([number[w] for w in t.words]) for t in found]
        self.rarity = np.ones(len(self.words))
        # of each template: word -> its places
        self.postings = [{w: np.flatnonzero(own == w) for w in np.unique(own).tolist()} for own in self.numbers]

    def numbers_of(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for words that no template has."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.number_at[at], -1)


def _frequencies(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(index.words), np.int64), 0
        for batch in batches:
            for texts in chunks(batch):
                words = texts.words(LETTERS, lower=True)
                number = index.numbers_of(words.hashes())
                seen = np.flatnonzero(number >= 0)
                pairs = np.unique(words.text_of()[seen] * len(index.words) + number[seen])
                total += np.bincount(pairs % len(index.words), minlength=len(index.words))
                rows += len(texts)
        yield pa.RecordBatch.from_pydict({"word": np.arange(-1, len(total)), "files": np.append(rows, total)})

    return run


def _starts(template: int, index: Index, number: np.ndarray, text_of: np.ndarray, places: dict[int, np.ndarray]) -> np.ndarray:
    """Offsets where the template's key phrase stands, found by its rarest word."""
    own, rarity = index.numbers[template], index.rarity
    first, end = index.templates[template].key
    none = np.zeros(0, np.int64)
    by_rarity = sorted(range(first, end), key=lambda t: (-rarity[own[t]], t))
    offsets = places.get(own[by_rarity[0]], none) - by_rarity[0]
    offsets = offsets[(offsets + first >= 0) & (offsets + end <= len(number))]
    for t in by_rarity[1:]:
        offsets = offsets[number[offsets + t] == own[t]]
    return offsets[text_of[offsets + first] == text_of[offsets + end - 1]] if len(offsets) else offsets


def _rarest(index: Index, number: np.ndarray, text_of: np.ndarray, known: np.ndarray) -> dict[int, np.ndarray]:
    """Places of the licence words that are among the rarest of their file, by word."""
    size = len(index.words)
    pairs, pair_of = np.unique(text_of[known] * size + number[known], return_inverse=True)
    text, word = pairs // size, pairs % size
    order = np.lexsort((word, -index.rarity[word], text))
    rank = np.empty(len(pairs), np.int64)
    rank[order] = np.arange(len(pairs)) - np.searchsorted(text[order], text[order])
    some = known[(rank < LOOKED_UP)[pair_of]]
    by_word = np.argsort(number[some], kind="stable")
    found, begins = np.unique(number[some][by_word], return_index=True)
    return dict(zip(found.tolist(), np.split(some[by_word], begins[1:])))


def _agreed(template: int, index: Index, rare: dict[int, np.ndarray], text_of: np.ndarray) -> np.ndarray:
    """Offsets on which rare words of a file agree for a template, and whose key phrase would stand in that file.

    An offset is that of the file its first agreeing word is in: a word of another file cannot agree on the key phrase.
    """
    posted = [(places, at) for w, spots in index.postings[template].items() if (places := rare.get(w)) is not None for at in spots.tolist()]
    if not posted:
        return np.zeros(0, np.int64)
    offsets, times = np.unique(np.concatenate([places - at for places, at in posted]), return_counts=True)
    first, end = index.templates[template].key
    offsets = offsets[times >= min(AGREE, len(index.numbers[template]))]
    offsets = offsets[(offsets + first >= 0) & (offsets + end <= len(text_of))]
    return offsets[text_of[offsets + first] == text_of[offsets + end - 1]] if len(offsets) else offsets


def _stands(template: int, index: Index, number: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The offsets at which the template's key phrase stands."""
    first, end = index.templates[template].key
    for t in range(first, end):
        offsets = offsets[number[offsets + t] == index.numbers[template][t]]
    return offsets


def scan_texts(texts: Texts, index: Index) -> pa.RecordBatch:
    words = texts.words(LETTERS, lower=True)
    number, text_of = index.numbers_of(words.hashes()), words.text_of()
    known = np.flatnonzero(number >= 0)
    order = np.argsort(number[known], kind="stable")
    found, begins = np.unique(number[known][order], return_index=True)
    places = dict(zip(found.tolist(), np.split(known[order], begins[1:])))
    rare = _rarest(index, number, text_of, known)
    n = len(texts)
    count, low, high = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
    score, base, more = np.zeros(n), [set() for _ in range(n)], [set() for _ in range(n)]
    for i, template in enumerate(index.templates):
        agreed = _stands(i, index, number, _agreed(i, index, rare, text_of))
        offsets = np.union1d(agreed, _starts(i, index, number, text_of, places))
        if not len(offsets):
            continue
        first = template.key[0]
        text = text_of[offsets + first]
        if template.base:
            at = offsets - words.offsets[text]
            np.add.at(count, text, 1)
            np.minimum.at(low, text, at)
            np.maximum.at(high, text, at)
            share = np.ones(len(offsets))
        else:
            share = np.zeros(len(offsets))
            for t, own in enumerate(index.numbers[i]):
                at = np.clip(offsets + t, 0, len(number) - 1)
                share += index.rarity[own] * ((at == offsets + t) & (number[at] == own) & (text_of[at] == text))
            share = np.minimum(1.0, share / index.rarity[index.numbers[i]].sum())
            text, share = text[share >= LEAST_SHARE], share[share >= LEAST_SHARE]
        np.maximum.at(score, text, share)
        for x in set(text.tolist()):
            (base if template.base else more)[x].add(template.label)
    none = count == 0
    return pa.RecordBatch.from_arrays(
        [
            texts.rows.column(0).cast(pa.int64()),
            pa.array(words.counts().astype(np.int64)),
            pa.array(count),
            pa.array(low, mask=none),
            pa.array(high, mask=none),
            pa.array([",".join(sorted(b)) for b in base]),
            pa.array([",".join(sorted(b | m)) for b, m in zip(base, more)]),
            pa.array(score),
        ],
        names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    )


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, any others) -> doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A NULL or empty text has no words and no labels (empty strings, score 0).  Every row gets
    a row of its own, also with a NULL or repeated doc_id; an empty table gives none.  Texts of any length are scanned whole, and
    the best of several places counts.  Other columns are not looked at, whatever their names.
    """
    spark = docs.sparkSession
    let_workers_import(spark)
    index = Index(templates())
    text = docs.select("doc_id", "text")
    # one row for each licence word and one for the number of files
    counts = text.mapInArrow(_frequencies(index), "word long, files long").groupBy("word").agg(F.sum("files").alias("files"))
    files = {r["word"]: r["files"] for r in counts.collect()}
    # every licence word counts as one file at least, so that rarity is finite and above 0
    index.rarity = np.array([math.log((files.get(-1, 0) + 2) / (files.get(i, 0) + 1)) for i in range(len(index.words))])
    index.rarity = np.maximum(index.rarity, 1e-9)
    shared = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch):
                yield scan_texts(texts, shared.value)

    return text.mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    )
