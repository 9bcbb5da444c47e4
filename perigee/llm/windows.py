"""First occurrences of fixed-length windows over all documents, by super-k-mer partitioning.

A document is a sequence of tokens (words or bytes). Each window has a minimiser: of the shorter grams
in it, the leftmost one with the smallest hash. Consecutive windows with the same minimiser, its anchor,
travel together as one packed string to the bucket of that gram, where equal windows must meet. In a
bucket, strings with the same anchor are sorted by what follows and by what precedes it; two windows are
equal exactly when their anchors stand at the same place in them and both sides agree, so no hash
decides about equality. How the strings of a bucket are compared is a parameter.

Skew: every task first merges equal strings of its own rows, so a passage with any number of copies
reaches its bucket once per task. Anchors that many different strings share are counted beforehand, and
their windows are dealt by the hash of the whole window instead.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import tasks

U = np.uint64
#: Fixed odd multipliers for hashing; any would do.
STEP, MIX_1, MIX_2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: Tokens hashed at once: their positions fit in POSITION_BITS.
POSITION_BITS = 21
BLOCK_BYTES = 1 << 20
#: Bytes of packed strings that a task merges before it sends them.
FLUSH_BYTES = 16 << 20
#: Bytes of packed strings, or of texts, meant for one bucket.
BUCKET_BYTES = 12 << 20
#: Buckets of one partition, where there are more than enough for the tasks.
PARTITION_BUCKETS = 16
#: Compression of what travels.
LEVEL = 5
#: Strings of a bucket compared at once, if nothing else is said.
SLAB_ROWS = 40_000
#: An anchor with more strings than this share of a bucket's is heavy.
HEAVY_SHARE = 0.25
#: Stands for a null id: such a row comes after all others.
NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Windows:
    """``size`` tokens a window, ``anchor`` tokens a minimiser; tokens are words or bytes.

    ``strict``: a window is removed only if it occurs in a document with a smaller id; otherwise also
    if it occurs earlier in the same document. ``slab``: strings of a bucket compared at once; more only if
    they share one anchor.
    """

    size: int
    anchor: int
    words: bool
    strict: bool
    slab: int = SLAB_ROWS

    @property
    def spread(self) -> int:
        return self.size - self.anchor

    def expansion(self) -> float:
        """Packed bytes sent for each byte of text: strings have about half the windows they could."""
        windows = (self.spread + 2) / 2
        return (windows + self.size - 1) / windows


# ---- hashing


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * MIX_1
    h = (h ^ (h >> U(27))) * MIX_2
    return h ^ (h >> U(31))


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of each ``size`` consecutive tokens, from hashes of ever longer grams."""
    total, covered, power, length, part = None, 0, int(STEP), 1, h
    while True:
        if size & length:
            if total is None:
                total, covered = part, length
            else:
                n = len(h) - covered - length + 1
                total = total[:n] * U(power) + part[covered : covered + n]
                covered += length
        if covered == size:
            return total
        part = part[:-length] * U(power) + part[length:]
        power, length = power * power % (1 << 64), 2 * length


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    length = 1
    while 2 * length <= size:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    return values if length == size else np.minimum(values[: len(values) - size + length], values[size - length :])


def byte_hashes(buffer: bytes) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=U) * STEP)[np.frombuffer(buffer, np.uint8)]


def word_hashes(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word, eight bytes at a time."""
    padded = buffer + bytes(8)
    eights = np.ndarray(len(buffer) + 1, "<u8", padded, strides=(1,))
    sizes = ends - starts
    h, at, left, done = mixed(sizes.astype(U)), np.arange(len(starts)), sizes, 0
    while len(at):
        keep = U(0xFFFFFFFFFFFFFFFF) >> (U(64) - U(8) * np.clip(left, 1, 8).astype(U))
        h[at] = mixed(h[at] * STEP + (eights[starts[at] + done] & keep))
        done += 8
        more = left > 8
        at, left = at[more], left[more] - 8
    return h


# ---- strings that travel


class Strings:
    """Packed strings in columns: id and tag of the document, first window, windows, place of the anchor, text."""

    KINDS = ("<i8", "<i4", "<u4", "<u2", "<u2", "<u4")

    def __init__(self, columns: list[np.ndarray], texts: list[bytes]):
        self.ids, self.tags, self.starts, self.counts, self.anchors, self.lengths = columns
        self.texts = texts

    @classmethod
    def of(cls, columns, texts):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        return cls([*(np.asarray(c, np.int64) for c in columns), lengths], texts)

    def __len__(self) -> int:
        return len(self.texts)

    def columns(self) -> list[np.ndarray]:
        return [self.ids, self.tags, self.starts, self.counts, self.anchors, self.lengths]

    def take(self, at: np.ndarray) -> Strings:
        return Strings([c[at] for c in self.columns()], [self.texts[i] for i in at.tolist()])

    def packed(self) -> bytes:
        ids = np.diff(self.ids, prepend=0)
        parts = [c.astype(k).tobytes() for c, k in zip([ids, *self.columns()[1:]], self.KINDS, strict=True)]
        head = len(self).to_bytes(8, "little")
        return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join([head, *parts, *self.texts]))

    @classmethod
    def unpacked(cls, data: bytes) -> Strings:
        raw = zstandard.ZstdDecompressor().decompress(data)
        n, at, columns = int.from_bytes(raw[:8], "little"), 8, []
        for kind in cls.KINDS:
            columns.append(np.frombuffer(raw, kind, n, at).astype(np.int64))
            at += n * np.dtype(kind).itemsize
        columns[0] = np.cumsum(columns[0])
        ends = (at + np.cumsum(columns[5])).tolist()
        return cls(columns, [raw[a:b] for a, b in zip([at, *ends[:-1]], ends, strict=True)])

    @classmethod
    def joined(cls, many: list[Strings]) -> Strings:
        columns = [np.concatenate(c) for c in zip(*(s.columns() for s in many), strict=True)]
        return cls(columns, [t for s in many for t in s.texts])


def merged(strings: Strings, spec: Windows) -> tuple[Strings, list[np.ndarray]]:
    """The strings less later copies of equal ones, and the runs that fall with those copies.

    Where only other documents count, a document's own copies of a string share its fate: one stays for all, and a run of
    no length says that the document repeats itself.
    """
    same = pa.array(strings.texts, pa.large_binary()).dictionary_encode().indices.to_numpy()
    order = np.lexsort((strings.starts, *([strings.tags] if spec.strict else []), strings.ids, same))
    first = np.ones(len(order), bool)
    first[1:] = same[order[1:]] != same[order[:-1]]
    # none precedes itself: repeated rows, and what a document repeats if only other documents count
    leader = np.repeat(order[first], np.diff(np.append(np.flatnonzero(first), len(order))))
    alike = strings.ids[order] == strings.ids[leader]
    if spec.strict:
        again = np.zeros(len(order), bool)
        again[1:] = ~first[1:] & alike[1:] & (strings.tags[order[1:]] == strings.tags[order[:-1]])
        first |= alike
    else:
        again = np.zeros(len(order), bool)
        first |= alike & (strings.starts[order] == strings.starts[leader])
    later, own = order[~first], order[again]
    runs = [strings.ids[later], strings.tags[later], strings.starts[later], strings.counts[later] + spec.size - 1]
    if len(own):
        marks = np.unique(np.stack([strings.ids[own], strings.tags[own]]), axis=1)
        none = np.zeros(marks.shape[1], np.int64)
        runs = [np.append(r, m) for r, m in zip(runs, (*marks, none, none), strict=True)]
    return strings.take(np.sort(order[first & ~again])), runs


class Cutter:
    """Cuts documents into packed strings, a block of tokens at a time."""

    def __init__(self, spec: Windows, heavy: np.ndarray):
        self.spec, self.heavy = spec, heavy

    def pieces(self, text: str | None) -> Iterator[tuple[int, int, bytes]]:
        """First token, number of tokens and bytes of overlapping pieces that hold every window of a text."""
        tokens = (text or "").encode()
        tokens = tokens.split() if self.spec.words else tokens
        step = (BLOCK_BYTES // 8 if self.spec.words else BLOCK_BYTES) - self.spec.size
        for at in range(0, len(tokens) - self.spec.size + 1, step):
            part = tokens[at : at + step + self.spec.size - 1]
            yield at, len(part), b" ".join(part) + b"\n" if self.spec.words else part

    def strings(self, pieces: list[tuple[int, int, int, int, bytes]]) -> tuple[Strings, np.ndarray, np.ndarray]:
        """Strings of a block of pieces (id, tag, first token, tokens, bytes); where they go; their anchors' hashes."""
        spec = self.spec
        buffer = b"".join(p[4] for p in pieces)
        if spec.words:
            octets = np.frombuffer(buffer, np.uint8)
            ends = np.flatnonzero((octets == 32) | (octets == 10))
            begins = np.append(0, ends[:-1] + 1)
            h = word_hashes(buffer, begins, ends)
        else:
            h = byte_hashes(buffer)
        counts = np.array([p[3] for p in pieces])
        limits = np.cumsum(counts)
        grams = mixed(gram_hashes(h, spec.anchor))
        places = np.arange(len(grams), dtype=U)
        keys = (grams >> U(POSITION_BITS) << U(POSITION_BITS)) | places
        least = sliding_least(keys, spec.spread + 1)
        inside = np.ones(len(least), bool)
        for limit in limits[:-1].tolist():
            inside[limit - spec.size + 1 : limit] = False
        windows = np.flatnonzero(inside)
        anchors = (least[windows] & U((1 << POSITION_BITS) - 1)).astype(np.int64)
        new = np.ones(len(windows), bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (windows[1:] != windows[:-1] + 1)
        firsts = np.flatnonzero(new)
        starts, at = windows[firsts], anchors[firsts]
        spans = np.diff(np.append(firsts, len(windows)))
        goes = mixed(grams[at] + STEP)
        if len(self.heavy):
            hot = np.isin(goes, self.heavy)
            if hot.any():
                single = np.repeat(hot, spans)
                extra, extra_at = windows[single], anchors[single]
                whole = mixed(gram_hashes(h, spec.size))[extra]
                starts, at = np.append(starts[~hot], extra), np.append(at[~hot], extra_at)
                spans = np.append(spans[~hot], np.ones(len(extra), np.int64))
                goes = np.append(goes[~hot], whole)
        owner = np.searchsorted(limits, starts, "right")
        base = np.array([p[2] for p in pieces]) - (limits - counts)
        last = starts + spans + spec.size - 2
        a, b = (begins[starts], ends[last]) if spec.words else (starts, last + 1)
        texts = [buffer[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        ids, tags = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
        return Strings.of([ids[owner], tags[owner], starts + base[owner], spans, at - starts], texts), goes

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Strings, np.ndarray]]:
        held, size = [], 0
        for batch in batches:
            for doc_id, tag, text in zip(*batch.columns, strict=True):
                for start, tokens, data in self.pieces(text.as_py()):
                    held.append((doc_id.as_py(), tag.as_py(), start, tokens, data))
                    size += len(data)
                    if size >= BLOCK_BYTES - (1 << 12):
                        yield self.strings(held)
                        held, size = [], 0
        if held:
            yield self.strings(held)


def _flushed(blocks: Iterator[tuple[Strings, np.ndarray]], spec: Windows):
    """Blocks put together up to FLUSH_BYTES and merged: strings, where they go, runs that fall."""
    held, size = [], 0

    def flush():
        strings = Strings.joined([b[0] for b in held])
        goes = np.concatenate([b[1] for b in held])
        # where a string goes rides along in place of nothing else: equal strings go to the same place
        keyed = dict(zip(strings.texts, goes.tolist(), strict=True))
        kept, runs = merged(strings, spec)
        return kept, np.array([keyed[t] for t in kept.texts], U), runs

    for block in blocks:
        held.append(block)
        size += int(block[0].lengths.sum())
        if size >= FLUSH_BYTES:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _runs_by_document(runs: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    ids, tags, starts, lengths = runs
    if len(ids):
        order = np.lexsort((starts, tags, ids))
        ids, tags = ids[order], tags[order]
        pairs = np.stack([starts[order], lengths[order]], axis=1).astype("<u4")
        cut = np.flatnonzero((ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(ids)], strict=True):
            yield int(ids[a]), int(tags[a]), pairs[a:b].tobytes()


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a bounded number of bytes; the last column is binary."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"") + 64
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


# ---- within a bucket


def _solved(strings: Strings, spec: Windows, compare: Callable) -> Iterator[list[np.ndarray]]:
    """Runs of windows that fall among the strings of one bucket, by what ``compare`` finds among those that share anchors."""
    strings = strings.take(np.lexsort((strings.starts + strings.anchors, strings.ids)))
    sizes = strings.counts + spec.size - 1
    ends = np.cumsum(sizes)
    at = ends - sizes + strings.anchors
    if spec.words:
        data = b"".join([t + b" " for t in strings.texts])
        edges = np.append(0, np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1)
        buffers = [None, pa.py_buffer(edges), pa.py_buffer(data)]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, buffers)
        tokens = (words.dictionary_encode().indices.to_numpy() + 1).astype(np.uint32)
        low, high = edges[at], edges[at + spec.anchor] - 1
    else:
        data = b"".join(strings.texts)
        tokens = np.frombuffer(data, np.uint8)
        low, high = at, at + spec.anchor
    grams = [data[i:j] for i, j in zip(low.tolist(), high.tolist(), strict=True)]
    anchor = pa.array(grams, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    often = np.bincount(anchor, minlength=1)
    rows = np.flatnonzero(often[anchor] > 1)
    rows = rows[np.argsort(anchor[rows], kind="stable")]
    cuts = np.flatnonzero(np.diff(anchor[rows], prepend=-1))
    begin, slab = 0, min(spec.slab, SLAB_ROWS)
    while begin < len(rows):
        k = np.searchsorted(cuts, begin + slab, "right") - 1
        end = cuts[k] if k >= 0 and cuts[k] > begin else (cuts[cuts > begin][0] if (cuts > begin).any() else len(rows))
        if len(rows) - begin <= slab:
            end = len(rows)
        at = np.sort(rows[begin:end])
        begin = end
        yield compare(strings, spec, at, anchor[at], tokens, ends[at] - sizes[at], ends[at])


def by_sides(strings, spec, at, anchor, tokens, low, high) -> list[np.ndarray]:
    """Runs that fall among the strings ``at``, which have tokens ``low`` to ``high``, by sorting what stands beside the anchors."""
    place, n, spread = strings.anchors[at], len(at), spec.spread
    middle = low + place
    left = _side(tokens, middle[:, None] - 1 - np.arange(spread), low[:, None], high[:, None])
    right = _side(tokens, middle[:, None] + spec.anchor + np.arange(spread), low[:, None], high[:, None])
    left_class, right_class = _classes(anchor, left), _classes(anchor, right)
    falls = np.zeros((n, spread + 1), bool)  # by tokens before the anchor
    ids, counts, middle_at = strings.ids[at], strings.counts[at], strings.starts[at] + place
    for before in range(spread + 1):
        has = np.flatnonzero((place - counts < before) & (before <= place))
        if len(has) < 2:
            continue
        key = right_class(spread - before)[has] * n + left_class(before)[has]
        by = np.argsort(key, kind="stable")
        key = key[by]
        first = np.ones(len(by), bool)
        first[1:] = key[1:] != key[:-1]
        if first.all():
            continue
        leader = np.repeat(has[by[first]], np.diff(np.append(np.flatnonzero(first), len(by))))
        own = has[by]
        late = ids[own] > ids[leader]
        if not spec.strict:
            late |= (ids[own] == ids[leader]) & (middle_at[own] > middle_at[leader])
        falls[has[by[late]], before] = True
    # runs of falling windows of a string, from its first window on
    steps = np.zeros((n, spread + 3), np.int8)
    steps[:, 1:-1] = falls[:, ::-1]
    change = np.diff(steps, axis=1)
    row, a = np.nonzero(change == 1)
    _, b = np.nonzero(change == -1)
    start = strings.starts[at][row] + place[row] - (spread - a)
    return [ids[row], strings.tags[at][row], start, b - a + spec.size - 1]


def _side(tokens: np.ndarray, index: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Tokens at ``index``, 0 outside the string. A string's own zero bytes do no harm: a window is
    compared only on tokens that both strings have."""
    inside = (index >= low) & (index < high)
    return np.where(inside, tokens[np.where(inside, index, 0)], tokens.dtype.type(0))


def _classes(anchor: np.ndarray, side: np.ndarray) -> Callable[[int], np.ndarray]:
    """For a length: a number for each row, equal where anchor and so many tokens are equal."""
    by = np.lexsort((*reversed(blocks_of(side)), anchor))
    equal = side[by[1:]] == side[by[:-1]]
    common = np.where(equal.all(axis=1), side.shape[1], equal.argmin(axis=1))
    common = np.append(-1, np.where(anchor[by[1:]] == anchor[by[:-1]], common, -1))
    index = np.arange(len(by))

    def of(length: int) -> np.ndarray:
        out = np.empty(len(by), np.int64)
        out[by] = np.maximum.accumulate(np.where(common < length, index, 0))
        return out

    return of


def blocks_of(side: np.ndarray) -> list[np.ndarray]:
    """The side's tokens as columns of unsigned 64-bit numbers that sort like the tokens."""
    per = 8 // side.dtype.itemsize
    wide = np.zeros((len(side), -(-side.shape[1] // per) * per), side.dtype.newbyteorder(">"))
    wide[:, : side.shape[1]] = side
    return list(wide.view(">u8").astype(U).T)


# ---- the whole


#: An anchor with fewer strings in a flush is sent as if it had as many, with a chance of its share of them.
SENT = 16


def _anchor_weights(spec: Windows) -> Callable:
    """Per task: anchors with the number of their different strings.

    Few strings are counted by chance, which the anchor and the flush decide: ``n`` strings of an anchor are counted as
    ``n`` on average, with a deviation below the square root of ``SENT * n`` however they are spread over flushes. That is
    some hundredths of the numbers that make an anchor heavy, and takes a sixteenth of the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for strings, goes, _ in _flushed(Cutter(spec, np.empty(0, U)).blocks(batches), spec):
            found, counts = np.unique(goes, return_counts=True)
            flush = np.array([int(strings.ids[0]) * 31 + int(strings.starts[0]) & (1 << 63) - 1], U) if len(goes) else np.zeros(1, U)
            chance = (mixed(found ^ mixed(flush + STEP)) % U(SENT)).astype(np.int64)
            sent = counts > chance
            counts = np.maximum(counts, SENT)[sent]
            yield pa.RecordBatch.from_arrays([pa.array(found[sent].view(np.int64)), pa.array(counts)], names=["goes", "n"])

    return run


def falling_runs(docs: DataFrame, spec: Windows, compare: Callable, total: int) -> DataFrame:
    """``id, tag, data`` for documents ``id, tag, text``: runs of tokens (start, length, as pairs of unsigned
    32-bit numbers) that are covered by windows with an earlier occurrence; several rows per document. ``total`` is the number of bytes of all texts."""
    buckets = max(1, math.ceil(total * spec.expansion() / BUCKET_BYTES))
    # strings in a bucket, from their mean length in bytes; a heavy anchor fills much of one
    mean = (spec.spread / 2 + spec.size) * (6.5 if spec.words else 1)
    limit = max(64, int(HEAVY_SHARE * BUCKET_BYTES / mean))
    weights = docs.mapInArrow(_anchor_weights(spec), "goes long, n long").groupBy("goes").agg(F.sum("n").alias("n"))
    # at most total strings / limit rows: a few for each bucket
    heavy = np.array([r[0] for r in weights.filter(F.col("n") > limit).collect()], np.int64).view(U)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int64()), ("id", pa.int64()), ("tag", pa.int32()), ("data", pa.binary())])

        def rows():
            for strings, goes, runs in _flushed(Cutter(spec, heavy).blocks(batches), spec):
                for doc_id, tag, data in _runs_by_document(runs):
                    yield -1 - (doc_id * 31 + tag) % buckets, doc_id, tag, data
                bucket = (goes % U(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                cuts = np.append(np.flatnonzero(np.diff(bucket[by], prepend=-1)), len(by))
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    yield int(bucket[by[a]]), None, None, strings.take(by[a:b]).packed()

        yield from _batches(rows(), schema)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("tag", pa.int32()), ("data", pa.binary())])

        def rows():
            held, size, current = [], 0, None

            def done():
                for runs in _solved(Strings.joined(held), spec, compare):
                    yield from _runs_by_document(runs)

            for batch in batches:
                for bucket, doc_id, tag, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if bucket < 0:
                        yield doc_id, tag, data
                        continue
                    if bucket != current:
                        if held:
                            yield from done()
                        held, size, current = [], 0, bucket
                    held.append(Strings.unpacked(data))
                    size += int(held[-1].lengths.sum())
                    if size > 2 * BUCKET_BYTES:  # copies that several tasks sent
                        kept, runs = merged(Strings.joined(held), spec)
                        yield from _runs_by_document(runs)
                        held, size = [kept], int(kept.lengths.sum()) // 2
            if held:
                yield from done()

        yield from _batches(rows(), schema)

    return (
        docs.mapInArrow(cut, "bucket long, id long, tag int, data binary")
        .repartition(_partitions(docs, buckets), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(solve, "id long, tag int, data binary")
    )


def _partitions(docs: DataFrame, buckets: int) -> int:
    """Partitions that buckets are dealt to: several buckets in one, but enough for all tasks. One bucket is held at a time."""
    return max(min(buckets, 4 * tasks(docs.sparkSession)), math.ceil(buckets / PARTITION_BUCKETS))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, id, tag, text``: an id without nulls, and a tag that tells rows with the same id apart."""
    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        (F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")) - (1 << 31)).cast("int").alias("tag"),
        "text",
    )


def with_runs(docs: DataFrame, spec: Windows, compare: Callable, finish: Callable, schema: str) -> DataFrame:
    """``finish(doc_id, text, runs)`` for every row: a tuple of ``schema`` from its bytes and the runs of tokens that fall.

    Texts travel to their runs once, packed like the strings.
    """
    rows = keyed(docs)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    places = max(1, math.ceil(total / BUCKET_BYTES))
    runs = falling_runs(rows.select("id", "tag", "text"), spec, compare, total)
    runs = runs.select(F.pmod(F.xxhash64("id", "tag"), F.lit(places)).alias("place"), "id", "tag", "data")
    texts = rows.withColumn("place", F.pmod(F.xxhash64("id", "tag"), F.lit(places)))
    texts = texts.mapInArrow(_packed_texts, "place long, id long, tag int, data binary")

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results():
            held, current = ({}, []), None
            for batch in batches:
                for place, doc_id, tag, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if place != current:
                        yield from _finished(*held, finish)
                        held, current = ({}, []), place
                    if tag is None:
                        held[1].append(data)
                    else:
                        held[0].setdefault((doc_id, tag), []).append(data)
            yield from _finished(*held, finish)

        yield from _batches(results(), _arrow(schema))

    both = texts.union(runs).repartition(_partitions(docs, places), "place").sortWithinPartitions("place")
    return both.mapInArrow(done, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(","))])


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows put together by place up to FLUSH_BYTES and compressed; a text is never cut."""
    schema = pa.schema([("place", pa.int64()), ("id", pa.int64()), ("tag", pa.int32()), ("data", pa.binary())])

    def rows():
        held, size = {}, 0
        for batch in batches:
            for doc_id, key, tag, text, place in zip(*batch.columns, strict=True):
                data = (text.as_py() or "").encode()
                held.setdefault(place.as_py(), []).append((doc_id.as_py(), key.as_py(), tag.as_py(), data))
                size += len(data) + 100
                if size >= FLUSH_BYTES:
                    yield from _sent(held)
                    held, size = {}, 0
        yield from _sent(held)

    yield from _batches(rows(), schema)


def _sent(held: dict[int, list[tuple]]) -> Iterator[tuple]:
    pack = zstandard.ZstdCompressor(level=LEVEL)
    for place, docs in held.items():
        yield place, None, None, pack.compress(pickle.dumps(docs))


def _finished(runs: dict, texts: list[bytes], finish: Callable) -> Iterator[tuple]:
    for data in texts:
        for doc_id, key, tag, text in pickle.loads(zstandard.ZstdDecompressor().decompress(data)):
            yield finish(doc_id, text, runs.get((key, tag)))


def covered(runs: list[bytes] | None, n: int) -> np.ndarray:
    """Which of ``n`` tokens the runs cover."""
    edge = np.zeros(n + 1, np.int64)
    for data in runs or ():
        pairs = np.frombuffer(data, "<u4").astype(np.int64).reshape(-1, 2)
        np.add.at(edge, pairs[:, 0], 1)
        np.add.at(edge, pairs.sum(axis=1), -1)
    return np.cumsum(edge[:-1]) > 0


def window_classes(tokens: list[bytes], size: int) -> np.ndarray:
    """A number for each window of ``size`` tokens, equal where the windows are: pairs of numbers of shorter windows get numbers."""

    def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]

    names = pa.array(tokens, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    length = 1
    while 2 * length <= size:
        names = paired(names[:-length], names[length:])
        length *= 2
    rest = size - length
    return paired(names[: len(names) - rest], names[rest:]) if rest else names


def covered_with_repeats(runs: list[bytes] | None, tokens: list[bytes], size: int) -> np.ndarray:
    """``covered``, and for a document that repeats itself also the windows that are equal to one that falls."""
    n, pairs = len(tokens), [np.frombuffer(data, "<u4").astype(np.int64).reshape(-1, 2) for data in runs or ()]
    if not any((p[:, 1] == 0).any() for p in pairs) or not any((p[:, 1] > 0).any() for p in pairs):
        return covered(runs, n)
    edge = np.zeros(n - size + 2, np.int64)
    for p in pairs:
        p = p[p[:, 1] > 0]
        np.add.at(edge, p[:, 0], 1)
        np.add.at(edge, p.sum(axis=1) - size + 1, -1)
    fallen = np.cumsum(edge[:-1]) > 0
    classes = window_classes(tokens, size)
    falls = np.zeros(int(classes.max(initial=0)) + 1, bool)
    falls[classes[fallen]] = True
    starts = np.flatnonzero(falls[classes])
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge[:-1]) > 0
