"""Toxicity scores by a linear classifier with counterfactual regularisation.

The classifier weighs the distinct words of a text and their beginnings. In labelled sentences that
mention a group, the mention is swapped for another group's, and a change of the score is penalised
along with the errors: what is left to tell toxic from harmless is not who is spoken of. Weights are
sparse and not negative, so the many harmless words of a long text hide nothing. Nor do they add up: only
words and beginnings that toxic rows have far more often than chance count, and a text is scored by its
strongest stretch of words, in learning as in scoring.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import saved
from perigee.llm.labelled import held_out, sample

#: Rows are held out if crc32 of the id leaves FOLD of FOLDS.
FOLDS, FOLD = 3, 1
#: At most so many labelled rows are learned from, unless told otherwise.
FIT_ROWS = 12_000
BUCKETS = 1 << 20
#: Lengths of the beginnings of words that count beside the words.
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.7
EPOCHS, RATE, SPARSITY = 3, 0.5, 0.8
#: Words of a stretch; share of chance finds among the words and beginnings that count.
STRETCH, CHANCE = 128, 0.01
#: Toxic rows are the fewer ones and count so many times.
TOXIC_WEIGHT = 3.0
#: Weight of the penalty on score changes under swaps, and swaps of each mention.
SWAP_WEIGHT, SWAPS = 1.0, 2
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
#: Mentions of groups by language and kind; a mention is swapped within its list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("deaf", "blind", "disabled", "elderly", "young"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("ausländer", "flüchtlinge", "einwanderer", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes", "athées"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "budistas", "ateos"),
)


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def _bucket(key: str) -> int:
    return zlib.crc32(key.encode()) % BUCKETS


def features_of(words: set[str]) -> Counter:
    """Buckets of the words and of the beginnings of longer ones, with their numbers."""
    found = Counter(map(_bucket, words))
    found.update(_bucket(w[:n] + "*") for w in words for n in BEGINNINGS if len(w) > n)
    return found


def swapped(text: str | None, terms=IDENTITY_TERMS, swaps: int = SWAPS) -> list[tuple[set[str], set[str]]]:
    """Words of each sentence that mentions a group, with the words after its mentions are swapped."""
    kin = {t: group for group in terms for t in group}
    out = []
    for sentence in SENTENCE.split((text or "").lower()):
        words = words_of(sentence)
        mentioned = sorted(words & kin.keys())
        for k in range(1, swaps + 1) if mentioned else ():
            moved = {kin[t][(kin[t].index(t) + k) % len(kin[t])] for t in mentioned}
            out.append((words, (words - set(mentioned)) | moved))
    return out


def _encoded(items: Counter) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(items.keys(), np.int64, len(items)), np.fromiter(items.values(), np.float64, len(items))


class Model:
    """Follow-the-regularised-leader logistic regression with weights that are sparse and never negative.

    Words can only speak for toxicity, so no length of harmless text hides it. The last weight is the
    intercept, which is free.
    """

    def __init__(self, sparsity: float = SPARSITY):
        self.z, self.n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
        self.sparsity = sparsity

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, free = self.z[at], at == BUCKETS
        shrunk = np.where(free, z, np.minimum(z + self.sparsity, 0.0))
        return -shrunk * RATE / (1.0 + np.sqrt(self.n[at]))

    def step(self, at: np.ndarray, gradient: np.ndarray) -> None:
        now = self.n[at]
        new = now + gradient**2
        self.z[at] += gradient - (np.sqrt(new) - np.sqrt(now)) / RATE * self.weights(at)
        self.n[at] = new


def strongest(values: list[tuple[int, str, float]], stretch: int = STRETCH) -> tuple[float, list[str]]:
    """Greatest sum over the distinct words of any ``stretch`` words in a row, and those words.

    ``values`` has place, word and a value that is not negative, in order of place, without the words that
    have none, so the work is linear in the words that count.
    """
    inside: Counter = Counter()
    best, at, total, tail = 0.0, (0, 0), 0.0, 0
    for head, (place, word, value) in enumerate(values):
        inside[word] += 1
        total += value if inside[word] == 1 else 0.0
        while values[tail][0] <= place - stretch:
            _, gone, lost = values[tail]
            inside[gone] -= 1
            total -= 0.0 if inside[gone] else lost
            tail += 1
        if total > best:
            best, at = total, (tail, head + 1)
    words = {word: value for _, word, value in values[at[0] : at[1]]}
    return sum(words.values()), list(words)


def bucket_counts(rows: Iterable[tuple[str | None, int]]) -> tuple[Counter, Counter]:
    """Rows that have each bucket, and toxic ones among them."""
    every, toxic = Counter(), Counter()
    for text, label in rows:
        found = features_of(words_of(text)).keys()
        every.update(found)
        if label:
            toxic.update(found)
    return every, toxic


def _evidence(at: np.ndarray, rows: np.ndarray, toxic: np.ndarray, base: float) -> dict[int, float]:
    """Buckets that toxic rows have more often than chance, by how unlikely that is (-log); ``base`` is the share of toxic rows.

    The chance is a Chernoff bound on the tail of the binomial; by the rule of Benjamini and Hochberg, a share of
    at most ``CHANCE`` of what counts is expected to be chance.
    """
    by_bucket = np.argsort(at)
    at, rows, toxic = at[by_bucket], rows[by_bucket].astype(np.float64), toxic[by_bucket].astype(np.float64)
    share = toxic / rows
    harmless = (1 - share) * np.log(np.where(share < 1, 1 - share, 1.0) / (1 - base))
    surprise = np.where(share > base, rows * (share * np.log(share / base) + harmless), 0.0)
    by = np.argsort(-surprise, kind="stable")
    passed = np.flatnonzero(surprise[by] >= np.log(max(len(at), 1) / CHANCE) - np.log(np.arange(len(at)) + 1.0))
    counted = by[: passed[-1] + 1] if len(passed) else by[:0]
    return dict(zip(at[counted].tolist(), surprise[counted].tolist(), strict=True))


def _counted(found: Counter, evidence: dict[int, float]) -> Counter:
    return Counter({k: v for k, v in found.items() if v and k in evidence})


def learnable(text: str | None, scorer: Scorer, swaps: bool = True) -> tuple[list[tuple[int, str]], list[tuple[np.ndarray, np.ndarray]]]:
    """What is learned from a text: places and words that have evidence, and by how much each swap changes each bucket.

    ``scorer`` has the evidence as weights.
    """
    changes = []
    for a, b in swapped(text) if swaps else []:
        change = features_of(a)
        change.subtract(features_of(b))
        changes.append(_encoded(_counted(change, scorer.weights)))
    return [(place, word) for place, word, _ in scorer.valued(text)], changes


def _plain(y: np.ndarray) -> dict[int, float]:
    share = float(np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3))
    return {BUCKETS: float(np.log(share / (1 - share)))}


def fit(texts: list[str | None], labels: list[int], swap_weight: float = SWAP_WEIGHT) -> dict[int, float]:
    """Weights by bucket, the intercept under ``BUCKETS``. Without both labels, an intercept only."""
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return _plain(y)
    every, toxic = bucket_counts(zip(texts, labels, strict=True))
    at = np.fromiter(toxic, np.int64, len(toxic))
    evidence = _evidence(at, np.array([every[k] for k in at.tolist()]), np.array([toxic[k] for k in at.tolist()]), float(y.mean()))
    scorer = Scorer({**evidence, BUCKETS: 0.0})
    return trained([learnable(text, scorer, bool(swap_weight)) for text in texts], y, evidence, swap_weight)


def trained(rows: list, y: np.ndarray, evidence: dict[int, float], swap_weight: float = SWAP_WEIGHT) -> dict[int, float]:
    """Weights learned from ``learnable`` rows."""
    scorer = Scorer({**evidence, BUCKETS: 0.0})
    model, order = Model(), np.random.default_rng(7)
    weights = dict(scorer.weights)
    for _ in range(EPOCHS):
        # the strongest stretch of each row: by evidence at first, then by the weights so far
        stretches = [strongest([(place, word, scorer[word]) for place, word in row])[1] for row, _ in rows]
        encoded = [_encoded(_counted(features_of(set(words)), evidence)) for words in stretches]
        for i in order.permutation(len(rows)).tolist():
            at, x = np.append(encoded[i][0], BUCKETS), np.append(encoded[i][1], 1.0)
            z = float(model.weights(at) @ x)
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]
            model.step(at, (TOXIC_WEIGHT if y[i] else 1.0) * error * x)
            for at, x in rows[i][1]:
                model.step(at, 2 * swap_weight * float(model.weights(at) @ x) * x)
        everything = model.weights(np.arange(BUCKETS + 1))
        kept = np.flatnonzero(everything)
        weights = {BUCKETS: float(everything[BUCKETS]), **dict(zip(kept.tolist(), everything[kept].tolist(), strict=True))}
        scorer = Scorer(weights)
    return weights


class Scorer(dict):
    """Weight of a word with its beginnings; words are looked up once."""

    KEPT = 300_000

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = self.weights.get(_bucket(word), 0.0)
        for n in BEGINNINGS:
            if len(word) > n:
                value += self.weights.get(_bucket(word[:n] + "*"), 0.0)
        if len(self) < self.KEPT:
            self[word] = value
        return value

    def valued(self, text: str | None) -> list[tuple[int, str, float]]:
        """Place, word and weight of the words of the text that have a weight."""
        words = WORD.findall((text or "").lower())
        some = {w: value for w in set(words) if (value := self[w])}
        return [(place, w, some[w]) for place, w in enumerate(words) if w in some] if some else []

    def score(self, text: str | None) -> float:
        z = self.weights[BUCKETS] + strongest(self.valued(text))[0]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def scored(docs: DataFrame, weights: dict[int, float]) -> DataFrame:
    """``doc_id, text, score`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights)
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def learned(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> dict[int, float]:
    """Weights learned from at most ``fit_rows`` rows with texts of any length.

    Tasks count buckets and then take what can be learned from each text; only that, and at most ``BUCKETS`` counts,
    reach the driver, never texts.
    """
    rows = saved(sample(docs, labels, "toxic", FOLDS, FOLD, fit_rows).select("id", "y", "text"), "toxicity-sample")
    number, toxic = rows.agg(F.count("*"), F.sum("y")).first()
    if not number or toxic in (0, number):
        return _plain(np.full(number, float(bool(toxic))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, bad = bucket_counts((batch.column(2)[k].as_py(), batch.column(1)[k].as_py()) for k in range(batch.num_rows))
            columns = pa.array(every.keys(), pa.int32()), pa.array(every.values(), pa.int64()), pa.array([bad[k] for k in every], pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns), names=["bucket", "n", "bad"])

    counts = rows.mapInArrow(count, "bucket int, n long, bad long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    table = counts.filter("bad > 0").toArrow()  # at most BUCKETS rows
    evidence = _evidence(*(table[c].to_numpy() for c in ("bucket", "n", "bad")), toxic / number)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer({**evidence, BUCKETS: 0.0})
        for batch in batches:
            for k in range(batch.num_rows):
                words, changes = learnable(batch.column(2)[k].as_py(), scorer)
                columns = [
                    pa.array([[place for place, _ in words]], pa.list_(pa.int32())),
                    pa.array([[word for _, word in words]], pa.list_(pa.string())),
                    pa.array([[at.tolist() for at, _ in changes]], pa.list_(pa.list_(pa.int32()))),
                    pa.array([[x.tolist() for _, x in changes]], pa.list_(pa.list_(pa.float64()))),
                ]
                names = ["id", "y", "places", "words", "changed", "by"]
                yield pa.RecordBatch.from_arrays([batch.column(0)[k : k + 1], batch.column(1)[k : k + 1], *columns], names=names)

    kinds = "id long, y int, places array<int>, words array<string>, changed array<array<int>>, by array<array<double>>"
    found = rows.mapInArrow(prepare, kinds).toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    columns = zip(*(found[c].to_pylist() for c in ("places", "words", "changed", "by")), strict=True)
    some = [
        (list(zip(places, words, strict=True)), [(np.array(at, np.int64), np.array(x, np.float64)) for at, x in zip(changed, by, strict=True)])
        for places, words, changed, by in columns
    ]
    return trained(some, found["y"].to_numpy().astype(np.float64), evidence)


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (doc_id, text).

    Scores depend on the text alone; null counts as empty, and an empty text gets the score of the
    intercept. Without labels to learn from, every score is near 0. Repeated rows get equal scores; a null
    doc_id is not held out. Texts of any length are learned from and scored whole; at most ``fit_rows`` labelled rows are
    learned from. Other columns are not read.
    """
    rows = scored(docs, learned(docs, labels, fit_rows))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return rows.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score", predicted.alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with all their columns."""
    weights = learned(docs, labels, fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights)
        for batch in batches:
            keep = [scorer.score(t.as_py()) < THRESHOLD for t in batch.column("text")]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
