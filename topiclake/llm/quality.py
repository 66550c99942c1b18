"""Quality rules: fixed counts, and a logistic regression over hashed word and character n-grams.

The model is trained on the labelled rows of the same corpus.  The fit takes at most
``rows_per_class`` rows of each class (those with the smallest hash of their id, so that
no part of the corpus is preferred); everything else covers all rows.  Features of the
sample are made in tasks and fitted in one task, bounded by ``rows_per_class`` vectors of
2 * 2^BITS numbers at most.  A quarter of the sample is held out to calibrate scores to
probabilities (Platt), weighted by how often each class occurs among all labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topiclake.llm.tables import let_workers_import
from topiclake.llm.words import Texts, Words, chunks, mix, windows

BITS = 16
SIZE = 1 << BITS
GRAM = 4
ROWS_PER_CLASS = 1500
#: a document is rejected when it is good with a smaller probability
LEAST_PROBABILITY = 0.5
#: the base rules: fewest words, and the largest share of repeated words in percent
LEAST_WORDS, MOST_REPEATED = 50, 50

# fixed value: characters that count as symbols
SYMBOLS = b"#*$%&|<>"

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SPACE_TEXT = " \t\n\v\f\r"


@dataclass
class Model:
    """Weights of word and character n-grams, and the calibration (slope, shift)."""

    weights: np.ndarray
    slope: float
    shift: float


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.float64 if flags.dtype.kind == "f" else np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated_words(words: Words, hashes: np.ndarray, size: int = 3) -> np.ndarray:
    """Whether each word is in a window of ``size`` words that its text has twice or more."""
    marked = np.zeros(len(hashes), bool)
    keys, text_of = windows(hashes, size), words.text_of()
    whole = np.flatnonzero(text_of[: len(keys)] == text_of[size - 1 :]) if len(keys) else np.zeros(0, np.int64)
    keys = mix(keys[whole] ^ mix(text_of[whole].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = whole[order[twice]]
    for i in range(size):
        marked[at + i] = True
    return marked


def _repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE_TEXT.encode())]
    return len(lines) - len(set(lines))


def stats(texts: Texts, words: Words, hashes: np.ndarray) -> list[pa.Array]:
    """The five counts of the base rules."""
    letters = words.inside & ((texts.data & 0xC0) != 0x80)
    symbol = np.isin(texts.data, np.frombuffer(SYMBOLS, np.uint8))
    raw, ends = texts.data.tobytes(), texts.offsets.tolist()
    return [
        pa.array(words.counts().astype(np.int64)),
        pa.array(_per_text(letters, texts.offsets)),
        pa.array(_per_text(symbol, texts.offsets)),
        pa.array([_repeated_lines(raw[a:b]) for a, b in zip(ends, ends[1:])], pa.int64()),
        pa.array(_per_text(_repeated_words(words, hashes), words.offsets)),
    ]


def grams(texts: Texts, words: Words, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature numbers, offsets by text) of words, pairs of words and GRAM bytes; pairs and
    bytes that would reach into the next text have the number 2 * SIZE, which weighs nothing."""
    none = 2 * SIZE

    def cut(numbers: np.ndarray, offsets: np.ndarray, size: int, total: int) -> np.ndarray:
        padded = np.full(total, none, np.int32)
        padded[: len(numbers)] = numbers
        for back in range(1, size):
            at = offsets[1:] - back
            padded[at[(at >= 0)]] = none
        return padded

    top = np.uint64(64 - BITS)
    yield (hashes >> top).astype(np.int32), words.offsets
    yield cut((windows(hashes, 2) >> top).astype(np.int32), words.offsets, 2, len(hashes)), words.offsets
    data, n = texts.data.astype(np.uint32), max(0, len(texts.data) - GRAM + 1)
    gram = np.zeros(n, np.uint32)
    for i in range(GRAM):
        gram |= data[i : i + n] << np.uint32(8 * i)
    number = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32) + SIZE
    yield cut(number, texts.offsets, GRAM, len(texts.data)), texts.offsets


def scores(model: Model, texts: Texts, words: Words, hashes: np.ndarray) -> np.ndarray:
    """The probability that each text is good."""
    weights = np.append(model.weights, 0.0)
    total = np.zeros(len(texts))
    for numbers, offsets in grams(texts, words, hashes):
        total += _per_text(weights[numbers], offsets) / np.maximum(1, np.diff(offsets))
    return 1 / (1 + np.exp(-np.clip(model.slope * total + model.shift, -30, 30)))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The feature shares of each labelled text, as (numbers, values)."""
    for batch in batches:
        for texts in chunks(batch):
            words = texts.words()
            found = list(grams(texts, words, words.hashes()))
            numbers, values = [], []
            for i in range(len(texts)):
                share = np.zeros(2 * SIZE + 1)
                for gram, offsets in found:
                    own = gram[offsets[i] : offsets[i + 1]]
                    np.add.at(share, own, 1 / max(1, len(own)))
                at = np.flatnonzero(share[:-1])
                numbers.append(at.astype(np.int32))
                values.append(share[at].astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [texts.rows.column(0), texts.rows.column(1), pa.array(numbers), pa.array(values)],
                names=["doc_id", "good", "numbers", "values"],
            )


def _ascend(x: tuple, good: np.ndarray, weight: np.ndarray, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and shift of a logistic regression, by Adam on all rows with a small ridge."""
    row, number, value = x
    w, first, second = np.zeros(2 * SIZE + 1), np.zeros(2 * SIZE + 1), np.zeros(2 * SIZE + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, value * w[number], len(good)) + w[-1]
        error = weight * (good - 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        slope = np.append(np.bincount(number, value * error[row], 2 * SIZE), error.sum()) - 1e-6 * w
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w += 0.5 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:-1], w[-1]


def _calibrate(z: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn scores into probabilities, by Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    scale = max(1e-9, float(np.abs(z).mean()))
    x = z / scale
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = weight * (good - p), weight * p * (1 - p) + 1e-9
        grad = np.array([(g * x).sum() - 0.01 * a, g.sum() - 0.01 * b])
        hess = np.array([[(h * x * x).sum() + 0.01, (h * x).sum()], [(h * x).sum(), h.sum() + 0.01]])
        move = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a + move[0], b + move[1]
    return a / scale, b


def fit(rows: pa.Table, priors: tuple[float, float]) -> Model | None:
    """A model from (doc_id, good, numbers, values); None when a class has fewer than 8 rows.

    ``priors``: how often bad and good labels occur among all labels.
    """
    good = rows["good"].to_numpy().astype(float)
    if min((good == 1).sum(), (good == 0).sum()) < 8:
        return None
    order = np.argsort(mix(rows["doc_id"].to_numpy().astype(np.uint64)), kind="stable")
    held = np.zeros(len(good), bool)
    for kind in (0, 1):
        held[order[good[order] == kind][::4]] = True
    numbers, values = rows["numbers"].combine_chunks(), rows["values"].combine_chunks()
    row = np.repeat(np.arange(len(good)), np.diff(numbers.offsets.to_numpy()))
    x = row, numbers.flatten().to_numpy(), values.flatten().to_numpy().astype(float)
    share = np.where(good == 1, 1 / (good == 1).sum(), 1 / (good == 0).sum())
    weights, _ = _ascend(x, good, np.where(held, 0, share))
    z = np.bincount(row, x[2] * weights[x[1]], len(good))
    prior = np.where(good == 1, priors[1] / (good[held] == 1).sum(), priors[0] / (good[held] == 0).sum())
    slope, shift = _calibrate(z[held], good[held], prior[held] * held.sum())
    return Model(weights, slope, shift)


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model | None:
    """Fit the model to ``labels`` (doc_id, quality 0 or 1) of ``docs``; rows with NULLs do not count."""
    let_workers_import(docs.sparkSession)
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("good"))
    counts = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    chosen = None
    for kind in (0, 1):
        some = known.where(F.col("good") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    # at most 2 * rows_per_class rows
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "good", "text")
    vectors = sample.mapInArrow(_vectors, "doc_id long, good int, numbers array<int>, values array<float>")
    total = max(1, sum(counts.values()))
    priors = counts.get(0, 0) / total, counts.get(1, 0) / total

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fit(pa.Table.from_batches(rows), priors) if (rows := list(batches)) else None
        if model:
            yield pa.RecordBatch.from_pydict(
                {"weights": [model.weights], "slope": [model.slope], "shift": [model.shift]}
            )

    row = vectors.repartition(1).mapInArrow(fitted, "weights array<double>, slope double, shift double").first()
    return Model(np.array(row["weights"]), row["slope"], row["shift"]) if row else None


def judge(docs: DataFrame, model: Model | None, least_probability: float = LEAST_PROBABILITY) -> DataFrame:
    """``docs`` (doc_id, text, any others) -> doc_id, the five counts, base_failed, probability, kept.

    A NULL or empty text has no words and fails the base rules.  Without a model (no
    labels, or one class only) probability is NULL and the base rules decide alone.  Rows
    are judged one by one, so repeated rows and NULL ids get their own row each; an empty table gives none.  Texts of any length
    are read whole.  Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    let_workers_import(spark)
    shared = spark.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for texts in chunks(batch):
                words = texts.words()
                hashes = words.hashes()
                good = pa.nulls(len(texts), pa.float64()) if model is None else pa.array(scores(model, texts, words, hashes))
                yield pa.RecordBatch.from_arrays(
                    [texts.rows.column(0).cast(pa.int64()), *stats(texts, words, hashes), good],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "probability"],
                )

    counted = docs.select("doc_id", "text").mapInArrow(judged, f"doc_id long, {_STATS}, probability double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    passed = F.coalesce(F.col("probability") >= least_probability, F.lit(True))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & passed)


def keep_good(docs: DataFrame, model: Model | None, least_probability: float = LEAST_PROBABILITY) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns, whatever their names."""
    spark = docs.sparkSession
    let_workers_import(spark)
    shared = spark.sparkContext.broadcast(model)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for texts in chunks(batch):
                words = texts.words()
                hashes = words.hashes()
                n = words.counts()
                repeated = _per_text(_repeated_words(words, hashes), words.offsets)
                good = (n >= LEAST_WORDS) & (100 * repeated <= MOST_REPEATED * n)
                if model is not None:
                    good &= scores(model, texts, words, hashes) >= least_probability
                yield texts.rows.filter(pa.array(good))

    return docs.mapInArrow(passed, docs.schema)
