"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints are cut into three segments. Two that differ in at most four bits differ in at most one
bit of some segment, so they agree on one of that segment's variants, each of which leaves one bit
out. The 64 variants are an equality key; what meets there is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import saved, tasks
from perigee.llm.components import connected_components

#: First and past-the-end bit of each segment; links of up to four bits need three.
SEGMENTS = ((0, 22), (22, 43), (43, 64))
MAX_BITS = 4
SHINGLE_WORDS = 4
SEED = 42
#: Shingles whose bits are counted at once.
PIECE = 1 << 16
#: Fingerprints under one variant beyond which they are dealt to pairs of tiles.
TILE = 4096
#: Fingerprints under one variant up to which they are compared shift by shift.
SHORT_RUN = 48


def fingerprint_of(text: str | None) -> int:
    """64-bit SimHash of the word shingles; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    width = min(SHINGLE_WORDS, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), PIECE):
        spans = zip(starts[k : k + PIECE], ends[k : k + PIECE], strict=True)
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]
        octets = np.array(hashes, np.uint64).astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (a signed long with the fingerprint's bits) for every row, repeats included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint_of(text.as_py()) for text in batch.column(1)]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _variants(prints: DataFrame) -> DataFrame:
    """``key, fp, rep``: one row for each bit; the key has the segment without that bit, and the bit's number."""
    keys = []
    for low, high in SEGMENTS:
        for bit in range(low, high):
            mask = ((1 << high) - (1 << low)) & ~(1 << bit)
            signed = mask - (1 << 64) if mask >> 63 else mask
            cut = F.shiftrightunsigned(F.col("fp").bitwiseAND(F.lit(signed).cast("long")), low)
            keys.append(cut.bitwiseOR(F.lit(bit << 32).cast("long")))
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fp", "rep")


def links(prints: DataFrame) -> DataFrame:
    """Edges ``a, b`` between the ``rep`` of distinct fingerprints ``fp, rep`` that join all links.

    Short runs under a variant give each linked pair once, at the pair's first common variant; a
    long run gives the edges of a spanning forest of its links, never all pairs. A variant with over
    ``TILE`` fingerprints is dealt to pairs of tiles, so no task holds it whole and every pair still meets.
    """
    variants = _variants(prints)
    heavy = saved(variants.groupBy("key").count().filter(F.col("count") > TILE), "heavy-variants")
    n = tasks(prints.sparkSession)
    light = variants.join(heavy, "key", "left_anti").select("key", F.lit(0).alias("tile"), "fp", "rep")
    last = F.floor(F.col("count") / (TILE // 2)).cast("int")
    own = F.pmod(F.xxhash64("fp"), last + 1).cast("int")
    tiled = variants.join(heavy, "key").select("key", "fp", "rep", own.alias("own"), last.alias("last"))
    tiled = tiled.select("key", "fp", "rep", "own", F.explode(F.sequence(F.lit(0), "last")).alias("other"))
    pair = F.greatest("own", "other").cast("long") * (1 << 20) + F.least("own", "other")
    tiled = tiled.select("key", pair.alias("tile"), "fp", "rep")
    return (
        light.union(tiled)
        .repartition(n, "key", "tile")
        .sortWithinPartitions("key", "tile")
        .mapInArrow(_linked, "a long, b long")
        .distinct()
    )


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.empty((0, 4), np.int64)
    for batch in batches:
        rows = np.stack([np.asarray(c.cast(pa.int64())) for c in batch.columns], axis=1)
        held = np.concatenate([held, rows])
        last = np.flatnonzero((held[:, :2] != held[-1, :2]).any(axis=1))
        whole = last[-1] + 1 if len(last) else 0
        yield _edges(held[:whole])
        held = held[whole:]
    yield _edges(held)


def _edges(rows: np.ndarray) -> pa.RecordBatch:
    key, tile, rep = rows[:, 0], rows[:, 1], rows[:, 3]
    fp = np.ascontiguousarray(rows[:, 2]).view(np.uint64)
    first = np.ones(len(rows), bool)
    first[1:] = (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])
    begins = np.flatnonzero(first)
    sizes = np.diff(np.append(begins, len(rows)))
    group = np.repeat(np.arange(len(begins)), sizes)
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    found = [np.empty((0, 2), np.int64)]
    for shift in range(1, int(sizes[sizes <= SHORT_RUN].max(initial=1))):
        i = np.flatnonzero(short[:-shift] & (group[:-shift] == group[shift:]))
        i = i[_first_meeting(fp[i] ^ fp[i + shift], key[i] >> 32)]
        found.append(np.stack([rep[i], rep[i + shift]], axis=1))
    for begin, size in zip(begins[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN], strict=True):
        found.append(_forest(fp[begin : begin + size], rep[begin : begin + size]))
    pairs = np.concatenate(found)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _first_meeting(differing: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Whether a pair links and ``bit`` is the first variant that both have."""
    linked = np.bitwise_count(differing) <= MAX_BITS
    first, undecided = np.full(len(differing), -1), np.ones(len(differing), bool)
    for low, high in SEGMENTS:
        part = differing & np.uint64((1 << high) - (1 << low))
        near = undecided & (np.bitwise_count(part) <= 1)
        where = np.where(part == 0, low, np.bitwise_count(part - np.uint64(1)))
        first = np.where(near, where, first)
        undecided &= ~near
    return linked & (first == bit)


def _forest(fp: np.ndarray, rep: np.ndarray) -> np.ndarray:
    """A spanning forest of the links within one run: linear in its size, whatever its shape."""
    left, edges, front = np.arange(len(fp)), [], []
    while len(left) or front:
        if not front:
            front, left = [left[0]], left[1:]
        at = front.pop()
        near = np.bitwise_count(fp[left] ^ fp[at]) <= MAX_BITS
        if near.any():
            reached = left[near]
            edges.append(np.stack([np.full(len(reached), rep[at]), rep[reached]], axis=1))
            front.extend(reached.tolist())
            left = left[~near]
    return np.concatenate(edges) if edges else np.empty((0, 2), np.int64)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (doc_id, text).

    Null and blank texts have fingerprint zero and link like any other. Equal fingerprints are one
    node before any search, so groups of copies of any size cost one row. A null doc_id lends no id to
    its group; alone it has a null component. Repeated rows stay repeated. Other columns are not read.
    """
    prints = saved(fingerprints(docs), "fingerprints")
    nodes = prints.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    nodes = saved(nodes, "fingerprint-nodes")
    labels = connected_components(links(nodes))
    classes = nodes.join(labels, nodes.rep == labels.node, "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return prints.join(classes, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose doc_id is the smallest of its group.

    Where different texts share such a doc_id, those that are in its group by their own fingerprint stay, one for each
    fingerprint: that with the smallest hash of its text, whatever the order of rows. Of repeated rows one stays. Rows
    without a doc_id stay.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    found = saved(near_duplicates(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("head"), "fingerprint").distinct(), "simhash-heads")
    repeated = rows.filter("id IS NOT NULL").groupBy(F.col("id").alias("again")).count().filter("count > 1").select("again")
    repeated = saved(repeated, "repeated-ids")
    kept = rows.join(found.select("head").distinct(), F.col("id") == F.col("head"), "left_semi")
    single = kept.join(repeated, F.col("id") == F.col("again"), "left_anti").select("row")
    doubled = saved(kept.join(repeated, F.col("id") == F.col("again"), "left_semi"), "repeated-rows")
    texts = doubled.groupBy("id", "digest").agg(F.first("row.text").alias("text"))
    prints = _fingerprints_by_digest(texts)
    first = prints.join(found, (F.col("id") == F.col("head")) & (F.col("fp") == F.col("fingerprint")), "left_semi")
    first = first.groupBy("id", "fp").agg(F.min("digest").alias("digest")).select("id", "digest")
    one = doubled.join(first, ["id", "digest"], "left_semi").groupBy("id", "digest").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return single.union(one.select("row")).union(rows.filter("id IS NULL").select("row")).select("row.*")


def _fingerprints_by_digest(texts: DataFrame) -> DataFrame:
    """``id, digest, fp`` (hex) for rows ``id, digest, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [f"{fingerprint_of(text.as_py()):016x}" for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.string())], names=["id", "digest", "fp"])

    return texts.select("id", "digest", "text").mapInArrow(run, "id long, digest string, fp string")
