"""Best-fit packing of documents into token sequences by linear grouping.

Only lengths matter to a packing, and there are fewer than ``SEQUENCE`` of them, so it is planned on
their counts, whatever the number of documents. Large lengths are put into groups of equal cardinality
and rounded up to the largest of their group; few-size configurations are found for those, with a
multiplicity each; actual lengths take the places of rounded ones; small lengths go where they fit best.
The plan has a bounded number of rows, each for many sequences, and documents find their place in it by
their rank among those of equal length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import saved, tasks
from perigee.llm.tokens import WordEncoder

SEQUENCE = 2048
#: Lengths above this share of a sequence are large; groups they are rounded in.
LARGE = 1 / 8
GROUPS = 96
#: Texts encoded together.
TEXTS = 1000


def pieces(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """``doc_id, copy, piece, start, length, ids_crc32`` (and ``ids``, packed) for every piece of every row.

    A row's ids are those of its text, then 0; null counts as empty. Rows longer than ``size`` are cut.
    ``copy`` tells repeated rows apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                rows = []
                for (doc_id, copy), ids in zip(
                    zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True),
                    encoder.encoded(part.column(1).cast(pa.binary()).to_pylist()),
                    strict=True,
                ):
                    ids += bytes(4)
                    for k, start in enumerate(range(0, len(ids), 4 * size)):
                        cut = ids[start : start + 4 * size]
                        rows.append((doc_id, copy, k, start // 4, len(cut) // 4, zlib.crc32(cut), cut))
                columns = list(zip(*rows, strict=True))[: 6 + with_ids]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "copy", "piece", "start", "length", "ids_crc32", "ids"][: 6 + with_ids],
                )

    schema = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("copy"))
    return rows.mapInArrow(run, schema)


# ---- the plan, on counts of lengths


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Kinds of sequences that hold ``counts`` pieces by length: how many of a kind, and its (length, number)."""
    large = {n: c for n, c in counts.items() if n > size * LARGE and c}
    small = {n: c for n, c in counts.items() if n <= size * LARGE and c}
    kinds: list[list] = []  # room left, how many, contents
    for times, lengths in _substituted(_configured(*_rounded(large), size), large):
        kinds.append([size - sum(lengths), times, Counter(lengths)])
    for length in sorted(small, reverse=True):
        _fit(kinds, length, small[length], size)
    return [(times, sorted(held.items(), reverse=True)) for _, times, held in kinds]


def _rounded(large: dict[int, int]) -> tuple[list[int], list[int]]:
    """Sizes and counts after rounding up within groups of equal cardinality. A length that has more
    pieces than a group keeps a size of its own."""
    total, sizes, numbers = sum(large.values()), [], []
    share = -(-total // GROUPS) if total else 1
    held = 0
    for length in sorted(large, reverse=True):
        if not held or held + large[length] > share:
            sizes.append(length)
            numbers.append(0)
            held = 0
        held += large[length]
        numbers[-1] += large[length]
    return sizes, numbers


def _configured(sizes: list[int], numbers: list[int], size: int) -> list[tuple[int, list[int]]]:
    """Configurations (how many, rounded sizes in each), each the fullest for its largest size.

    The largest size left opens sequences; a knapsack over what is left of the others fills them as far as
    possible, and the configuration is used as often as its scarcest size allows. Each use of up one size,
    so there are few configurations.
    """
    left, out = np.array(numbers, np.int64), []
    while left.any():
        first = int(np.flatnonzero(left)[0])
        chosen = [first] + _fullest(size - sizes[first], sizes, left - (np.arange(len(left)) == first))
        need = Counter(chosen)
        times = min(int(left[i]) // n for i, n in need.items())
        for i, n in need.items():
            left[i] -= times * n
        out.append((times, [sizes[i] for i in chosen]))
    return out


def _fullest(room: int, sizes: list[int], left: np.ndarray) -> list[int]:
    """Indexes of sizes, each at most as often as it is left, whose sum is the largest within ``room``."""
    best: dict[int, tuple[int, ...]] = {0: ()}
    for i, size in enumerate(sizes):
        if left[i] <= 0 or size > room:
            continue
        for total, chosen in list(best.items()):
            for n in range(1, min(int(left[i]), (room - total) // size) + 1):
                best.setdefault(total + n * size, chosen + (i,) * n)
        if room in best:
            break
    return list(best[max(best)])


def _substituted(configurations, large: dict[int, int]) -> list[tuple[int, list[int]]]:
    """Configurations with actual lengths in place of rounded ones, split where a length runs out."""
    lengths, out = sorted(large, reverse=True), []
    sizes = sorted({s for _, c in configurations for s in c}, reverse=True)
    queues: dict[int, list[list[int]]] = {}
    for i, size in enumerate(sizes):
        below = sizes[i + 1] if i + 1 < len(sizes) else 0
        queues[size] = [[n, large[n]] for n in lengths if below < n <= size]
    for times, chosen in configurations:
        need = Counter(chosen)
        while times:
            actual, step = [], times
            for size, n in need.items():
                length, available = queues[size][0]
                if available >= n:
                    step = min(step, available // n)
                    actual += [length] * n
                else:  # what several lengths have left fills one sequence
                    step, missing = 1, n
                    for queued, has in queues[size]:
                        taken = min(has, missing)
                        actual += [queued] * taken
                        missing -= taken
            for length, n in Counter(actual).items():
                size = next(s for s in need if any(q[0] == length for q in queues[s]))
                entry = next(q for q in queues[size] if q[0] == length)
                entry[1] -= n * step
                if not entry[1]:
                    queues[size].remove(entry)
            out.append((step, actual))
            times -= step
    return out


def _fit(kinds: list[list], length: int, count: int, size: int) -> None:
    """Put ``count`` pieces where they leave the least room, into new sequences where none has room."""
    while count:
        fits = [k for k in kinds if k[0] >= length]
        kind = min(fits, key=lambda k: k[0]) if fits else None
        if kind is None:
            each = min(size // length, count)
            times = count // each
            kinds.append([size - each * length, times, Counter({length: each})])
            count -= times * each
            continue
        each = min(kind[0] // length, count)
        times = min(kind[1], count // each)
        if times < kind[1]:
            kinds.append([kind[0], kind[1] - times, Counter(kind[2])])
        kind[0], kind[1] = kind[0] - each * length, times
        kind[2][length] += each
        count -= times * each


# ---- documents into the plan


def _places(kinds: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length: rows of first rank, first sequence, pieces in each sequence, place of the first."""
    rows: dict[int, list] = {}
    taken: Counter = Counter()
    sequence = 0
    for times, held in kinds:
        offset = 0
        for length, n in held:
            rows.setdefault(length, []).append((taken[length], sequence, n, offset))
            taken[length] += times * n
            offset += length * n
        sequence += times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def _ranked(rows: DataFrame) -> DataFrame:
    """``rank`` from 0 among the rows of a length. Ranks are taken within salted parts and moved up by the
    sizes of the parts before, so no task gets a length whole: the sizes are at most ``size`` x tasks rows."""
    salted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "copy"), tasks(rows.sparkSession)))
    sizes = salted.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = sizes.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("moved"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "copy")
    ranked = salted.withColumn("within", F.row_number().over(within) - 1)
    return ranked.join(moved, ["length", "part"]).withColumn("rank", F.col("within") + F.col("moved"))


def packed(docs: DataFrame, vocabulary: str, size: int = SEQUENCE) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of ``docs`` (doc_id, text).

    Sequences hold at most ``size`` ids. Empty and null texts are pieces of one id. Repeated rows and null
    ids are packed like any other. Other columns are not read.
    """
    rows = saved(pieces(docs, vocabulary, size), "pieces")
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most ``size`` rows
    places = _places(plan(counts, size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for n in np.unique(length).tolist():
                at, table = np.flatnonzero(length == n), places[n]
                row = table[np.searchsorted(table[:, 0], rank[at], "right") - 1]
                k = rank[at] - row[:, 0]
                sequence[at], offset[at] = row[:, 1] + k // row[:, 2], row[:, 3] + k % row[:, 2] * n
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return _ranked(rows).mapInArrow(place, schema)
