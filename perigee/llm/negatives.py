"""Hard negatives by Four-Russians scoring.

Components are integers. A candidate is packed as bit planes: for each bit of two's complement and each group
of eight dimensions one byte. For an anchor, a table has the sum of its components for each of the 256 subsets of
a group. So a plane's share of the inner product is a lookup for each group, and the exact score is the sum of the
planes, each shifted by its bit, the sign's plane taken away. Anchors come in blocks of a checked size, which
every task that scans candidates holds; what leaves a task are the best few for each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import saved, tasks
from perigee.session import fresh_folder

#: A component x becomes floor(SCALE * x).
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is from LEAST to MOST hundredths of the positive's.
LEAST, MOST = 30, 90
#: Anchors of one scan, at most; of one set of tables; candidates looked up at once.
BLOCK, TABLES, CHUNK = 8192, 256, 512
#: Candidates of one task, about.
TASK_ROWS = 1 << 20
NONE = np.iinfo(np.int64).min


def packed(numbers: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes ``[row, bit, group]`` of integers ``[row, dimension]``."""
    planes = [np.packbits((numbers >> b) & 1 != 0, axis=1, bitorder="little") for b in range(bits)]
    return np.stack(planes, axis=1) if numbers.shape[1] else np.zeros((len(numbers), bits, 0), np.uint8)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """``[group, subset, anchor]``: sums of the anchors' components in each subset of eight dimensions."""
    groups = -(-anchors.shape[1] // 8)
    padded = np.zeros((len(anchors), groups * 8), kind)
    padded[:, : anchors.shape[1]] = anchors
    sums = np.zeros((groups, 256, len(anchors)), kind)
    for i in range(8):
        sums[:, 1 << i : 2 << i] = sums[:, : 1 << i] + padded[:, i::8].T[:, None]
    return sums


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Exact inner products ``[candidate, anchor]``."""
    total = np.zeros((len(planes), sums.shape[2]), sums.dtype)
    found = np.empty_like(total)
    bits = planes.shape[1]
    for b in range(bits):
        plane = np.zeros_like(total)
        for g in range(planes.shape[2]):
            np.take(sums[g], planes[:, b, g], axis=0, out=found, mode="clip")
            plane += found
        if b == bits - 1:
            total -= plane << b
        else:
            total += plane << b
    return total


class Best:
    """The best few of each slot, by score, then by the smaller id."""

    FOLD = 200_000

    def __init__(self, slots: int, most: int):
        self.most, self.slots = most, slots
        self.held = np.empty((0, 3), np.int64)  # slot, score, id
        self.fresh: list[np.ndarray] = []
        self.waiting = 0
        #: A score below is among the best of its slot no more.
        self.floor = np.full(slots, NONE)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.fresh.append(np.stack([slot, score, ids], axis=1))
        self.waiting += len(slot)
        if self.waiting >= self.FOLD:
            self.fold()

    def fold(self) -> None:
        rows = np.concatenate([self.held, *self.fresh])
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        begins = np.searchsorted(rows[:, 0], np.arange(self.slots))
        place = np.arange(len(rows)) - begins[rows[:, 0]]
        self.held, self.fresh, self.waiting = rows[place < self.most], [], 0
        last = rows[place == self.most - 1]
        self.floor[last[:, 0]] = last[:, 1]


class Anchors:
    """A block of anchors: numbers of one length each, looked up by length."""

    def __init__(self, rows: list, kind: type):
        self.kind = kind
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        sizes = np.array([len(r["numbers"]) for r in rows], np.int64)
        self.by_size = {int(d): np.flatnonzero(sizes == d) for d in np.unique(sizes)}
        self.numbers = {d: np.array([rows[i]["numbers"] for i in at], np.int64).reshape(len(at), d) for d, at in self.by_size.items()}

    def scored(self, batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple]:
        """For every chunk of candidates and set of anchors: which anchors, ids, labels, scores."""
        for batch in batches:
            ids, labels, sizes = (np.asarray(batch.column(k)) for k in range(3))
            for d, at in self.by_size.items():
                rows = np.flatnonzero(sizes == d)
                if not len(rows):
                    continue
                groups = -(-d // 8)
                planes = np.frombuffer(b"".join(batch.column(3).take(pa.array(rows)).to_pylist()), np.uint8)
                planes = planes.reshape(len(rows), bits, groups)
                for begin in range(0, len(at), TABLES):
                    some = at[begin : begin + TABLES]
                    sums = subset_sums(self.numbers[d][begin : begin + TABLES], self.kind)
                    for low in range(0, len(rows), CHUNK):
                        chunk = rows[low : low + CHUNK]
                        yield some, ids[chunk], labels[chunk], scores(planes[low : low + CHUNK], sums).astype(np.int64)


def _sound(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").filter(~odd)


def _numbers() -> Column:
    return F.transform("vector", lambda x: F.floor(x * float(SCALE)).cast("long"))


def _packed(rows: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.array(v, np.float64) for v in batch.column(2).to_pylist()]
            sizes = np.array([len(v) for v in vectors], np.int32)
            out: list[bytes] = [b""] * len(vectors)
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d).tolist()
                numbers = np.floor(SCALE * np.array([vectors[i] for i in at]).reshape(len(at), d)).astype(np.int64)
                for i, planes in zip(at, packed(numbers, bits), strict=True):
                    out[i] = planes.tobytes()
            columns = [batch.column(0), batch.column(1), pa.array(sizes), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "size", "planes"])

    return rows.mapInArrow(run, "vec_id long, label long, size int, planes binary")


def _blocks(anchors: DataFrame) -> list[DataFrame]:
    """The anchors in blocks of at most ``BLOCK`` rows, which is checked."""
    number = max(1, -(-2 * anchors.count() // BLOCK))
    while True:
        block = F.pmod("anchor", F.lit(number))
        largest = anchors.groupBy(block.alias("block")).count().agg(F.max("count")).first()[0] or 0
        if largest <= BLOCK:
            return [anchors.filter(block == k) for k in range(number)] if largest else []
        number *= 2


def _best_of(found: DataFrame, most: int, *slot: str) -> DataFrame:
    order = Window.partitionBy(*slot).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _positives(candidates: DataFrame, anchors: Anchors, bits: int, most: int) -> DataFrame:
    """``slot, score, vec_id, rank`` of the best rows with an anchor's label; the slot is the anchor's place in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors.ids), most)
        for at, ids, labels, score in anchors.scored(batches, bits):
            row, column = np.nonzero(
                (labels[:, None] == anchors.labels[at]) & (ids[:, None] != anchors.ids[at]) & (score >= best.floor[at])
            )
            best.add(at[column], score[row, column], ids[row])
        best.fold()
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.held.T], names=["slot", "score", "vec_id"])

    return _best_of(candidates.mapInArrow(run, "slot long, score long, vec_id long"), most, "slot")


def _negatives(candidates: DataFrame, anchors: Anchors, bits: int, bounds: np.ndarray, most: int) -> DataFrame:
    """``slot, score, vec_id, rank`` of the best rows with another label than the anchor's and a score within bounds.

    ``bounds`` is ``[positive, least and most, anchor]``; the slot is the anchor's place times the positives plus the positive.
    """
    number = len(bounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors.ids) * number, most)
        for at, ids, labels, score in anchors.scored(batches, bits):
            other = (labels[:, None] != anchors.labels[at]) & (ids[:, None] != anchors.ids[at])
            for k in range(number):
                low = np.maximum(bounds[k, 0, at], best.floor[at * number + k])
                row, column = np.nonzero(other & (score >= low) & (score <= bounds[k, 1, at]))
                best.add(at[column] * number + k, score[row, column], ids[row])
        best.fold()
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.held.T], names=["slot", "score", "vec_id"])

    return _best_of(candidates.mapInArrow(run, "slot long, score long, vec_id long"), most, "slot")


def _mined(candidates: DataFrame, rows: list, bits: int, kind: type, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    anchors = Anchors(rows, kind)
    spark = candidates.sparkSession
    found = _positives(candidates, anchors, bits, positives).collect()  # at most BLOCK times positives
    bounds = np.zeros((positives, 2, len(rows)), np.int64)
    bounds[:, 0] = 1
    pairs = []
    for r in found:
        k, score = r["rank"] - 1, r["score"]
        bounds[k, :, r["slot"]] = -(-least * score // 100), most * score // 100
        pairs.append((r["slot"] * positives + k, int(anchors.ids[r["slot"]]), r["vec_id"], score))
    named = spark.createDataFrame(pairs, "slot long, anchor_id long, positive_id long, positive_score long")
    mined = _negatives(candidates, anchors, bits, bounds, negatives)
    # as many rows as were collected: a bounded side
    return mined.join(F.broadcast(named), "slot").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``vectors`` (vec_id, label, embedding).

    Anchors are the rows for which ``is_anchor``, a condition on vec_id and label, holds. An anchor's positives are the
    ``positives`` rows of its label with the highest scores; for each of them the ``negatives`` rows of other labels
    with the highest scores from ``least`` to ``most`` hundredths of the positive's are returned, ranked from 1. Equal
    scores go by the smaller vec_id. Scores are exact inner products of the components floor(256 x).

    Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part. Vectors of
    different lengths do not meet. Repeated rows are candidates as often as they occur and one anchor; a row with the
    anchor's own vec_id is no partner of it. Without anchors or partners there are no rows. Scores that could pass 62
    bits are refused. Other columns are not read. Every anchor is scored against every row: the candidates are scanned
    twice for each block of at most ``BLOCK`` anchors, without a shuffle of them.
    """
    rows, spark = _sound(vectors), vectors.sparkSession
    largest = F.max(F.coalesce(F.array_max(F.transform("vector", lambda x: F.abs(F.floor(x * float(SCALE)).cast("double")))), F.lit(0.0)))
    bound, size, number = rows.agg(largest, F.max(F.size("vector")), F.count("*")).first()
    if number and bound * bound * max(size, 1) >= 2.0**62:
        raise ValueError(f"components up to {bound / SCALE:g} in {size} dimensions: scores could pass 62 bits")
    bits = int(bound or 0).bit_length() + 1
    kind = np.int32 if (1 << bits) ** 2 * max(size or 0, 1) < 1 << 31 else np.int64
    parts = max(tasks(spark), -(-number // TASK_ROWS))
    candidates = saved(_packed(rows, bits).repartition(parts, "vec_id"), "packed-vectors")
    anchors = rows.filter(is_anchor).select("vec_id", "label", _numbers().alias("numbers")).distinct()
    anchors = saved(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    folder = fresh_folder(spark, "hard-negatives")
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], kinds).write.parquet(folder)
    for block in _blocks(anchors):
        mined = _mined(candidates, block.collect(), bits, kind, positives, negatives, least, most)  # at most BLOCK rows
        mined.write.mode("append").parquet(folder)
    return spark.read.schema(kinds).parquet(folder)
