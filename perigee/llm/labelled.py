"""Labelled rows to learn from: which may be learned, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """``id, y, text`` of at most ``rows`` labelled rows that are not held out, the same ones on every run.

    Texts are whole, whatever their length. Null labels and texts are left out; an id with both labels counts with each,
    and of texts that share an id one counts, that with the smallest checksum. At most ``rows`` ids are broadcast.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    chosen = usable.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label).cast("int").alias("y")).distinct()
    chosen = chosen.orderBy(F.xxhash64("label_id"), "label_id", "y").limit(rows)
    some = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter("text IS NOT NULL")
    joined = some.join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
    return joined.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
