"""Quality scores by supervised subword embeddings.

A text is the average of the vectors of its words, of their character n-grams and of repeated words,
all hashed into one table; a softmax over the two labels is put on the average. Vectors and softmax are
learned together by stochastic gradient descent in numpy. As the output is linear in the average, a
learned feature counts by one number when texts are scored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.labelled import held_out, sample

FOLDS, FOLD = 4, 2
#: At most so many labelled rows are learned from, unless told otherwise.
FIT_ROWS = 3_000
BUCKETS, SIZE = 1 << 17, 8
GRAMS = (3, 4)
THRESHOLD = 0.7
EPOCHS, RATE = 5, 0.3
#: Words of at most so many bytes are worth remembering; longer ones are worked out again.
REMEMBERED = 40
#: Features of a long word at a time.
PIECE = 1 << 16
#: Stands for a word that repeats the one before it.
AGAIN = b"\x00again"


def counts_of(text: str | None) -> Counter:
    """Words of a text with their numbers, and how many repeat the word before."""
    words = (text or "").encode().split()
    found = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    if again:
        found[AGAIN] = again
    return found


def features_of(word: bytes) -> list[int]:
    """Buckets of a word and of the character n-grams of the word between marks."""
    out = [zlib.crc32(word) % BUCKETS]
    if word != AGAIN:
        marked = b"<" + word + b">"
        for n in GRAMS:
            out += [zlib.crc32(marked[i : i + n], n) % BUCKETS for i in range(len(marked) - n + 1)]
    return out


def pieces_of(word: bytes) -> Iterator[list[int]]:
    """The features of a word of any length, a bounded number at a time."""
    yield [zlib.crc32(word) % BUCKETS]
    marked = b"<" + word + b">"
    for n in GRAMS:
        last = len(marked) - n + 1
        for low in range(0, last, PIECE):
            yield [zlib.crc32(marked[i : i + n], n) % BUCKETS for i in range(low, min(low + PIECE, last))]


def shares_of(text: str | None, known: dict[bytes, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's features and the share of each; ``known`` remembers short words."""
    found: Counter = Counter()
    for word, n in counts_of(text).items():
        if word in known:
            pieces = [known[word]]
        elif len(word) <= REMEMBERED:
            known[word] = features_of(word)
            pieces = [known[word]]
        else:
            pieces = pieces_of(word)
        for piece in pieces:
            for at in piece:
                found[at] += n
    by = np.fromiter(found.values(), np.float32, len(found))
    return np.fromiter(found.keys(), np.int32, len(found)), by / max(by.sum(), 1)


def fit(texts: list[str | None], labels: list[int]) -> tuple[np.ndarray, float]:
    """``fit_shares`` of texts."""
    known: dict[bytes, list[int]] = {}
    return fit_shares([shares_of(text, known) for text in texts], labels)


def fit_shares(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> tuple[np.ndarray, float]:
    """What each bucket adds to the log odds of label 1, and the intercept."""
    y = np.array(labels, np.int64)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    random = np.random.default_rng(11)
    vectors = random.uniform(-1 / SIZE, 1 / SIZE, (BUCKETS, SIZE)).astype(np.float32)
    out, bias = np.zeros((2, SIZE), np.float32), np.zeros(2, np.float32)
    steps, total = 0, EPOCHS * len(rows)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)).tolist():
            at, by = rows[i]
            rate = RATE * (1 - steps / total)
            steps += 1
            some = vectors[at]
            mean = by @ some
            logits = out @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1
            # as the average shrinks a feature's share, its step is scaled to the size of the largest
            vectors[at] = some - np.outer(by / max(float(by.max(initial=0)), 1e-9), rate * (p @ out))
            out -= rate * np.outer(p, mean)
            bias -= 0.1 * rate * p
    return vectors @ (out[1] - out[0]), float(bias[1] - bias[0])


class Scorer(dict):
    """Sum and number of the features of a word; words are looked up once."""

    KEPT = 300_000

    def __init__(self, adds: np.ndarray, intercept: float):
        super().__init__()
        self.adds, self.intercept = adds, intercept

    def __missing__(self, word: bytes) -> tuple[float, int]:
        if len(word) <= REMEMBERED:
            at = features_of(word)
            value = float(self.adds[at].sum()), len(at)
            if len(self) < self.KEPT:
                self[word] = value
            return value
        total, number = 0.0, 0
        for at in pieces_of(word):
            total += float(self.adds[at].sum())
            number += len(at)
        return total, number

    def score(self, text: str | None) -> float:
        total, number = 0.0, 0
        for word, n in counts_of(text).items():
            value, features = self[word]
            total += n * value
            number += n * features
        z = self.intercept + total / max(number, 1)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def learned(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """What is learned from at most ``fit_rows`` rows. Tasks take the features of texts of any length; only those, at most
    ``BUCKETS`` numbers a row, reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            for k in range(batch.num_rows):
                at, by = shares_of(batch.column(2)[k].as_py(), known)
                columns = [pa.array(c, t) for c, t in (([at], pa.list_(pa.int32())), ([by], pa.list_(pa.float32())))]
                yield pa.RecordBatch.from_arrays([batch.column(0)[k : k + 1], batch.column(1)[k : k + 1], *columns], names=["id", "y", "at", "by"])

    rows = sample(docs, labels, "quality", FOLDS, FOLD, fit_rows).select("id", "y", "text")
    features = rows.mapInArrow(run, "id long, y int, at array<int>, by array<float>").toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    shares = [(np.asarray(a.values), np.asarray(b.values)) for a, b in zip(features["at"], features["by"], strict=True)]
    return fit_shares(shares, features["y"].to_pylist())


def quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (doc_id, text).

    Scores depend on the text alone; null counts as empty, and an empty text gets the score of the
    intercept. Without labels to learn from, every score is 0.5. Repeated rows get equal scores; a null
    doc_id is not held out. Texts and words of any length are learned from and scored whole; at most ``fit_rows`` labelled
    rows are learned from. Other columns are not read. The model, a number for each bucket, travels with the tasks.
    """
    adds, intercept = learned(docs, labels, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(adds, intercept)
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score", predicted.alias("predicted"))
