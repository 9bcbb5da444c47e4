"""Tables stored by key: rows of equal keys lie in the same bucket, so joins on the key move no rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.sinks.parquet import write_parquet


@dataclass(frozen=True)
class KeyedTable:
    """Rows with a whole key in the bucketed table ``name``, those with a NULL in their key in the folder ``unkeyed``."""

    name: str
    unkeyed: str
    key: tuple[str, ...]
    buckets: int

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def without_key(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.rows(spark).schema).parquet(self.unkeyed)


def store_by_key(df: DataFrame, name: str, path: str, key: Sequence[str], buckets: int) -> KeyedTable:
    """Store ``df`` under ``path`` and enter it in the catalog as ``name``, replacing what was there.

    Each bucket is one sorted file, read by one task: choose as many that a bucket fits one. Tables that are to be joined
    need the same key types and number of buckets. Rows with a NULL in their key, which match nothing and would all
    be of one bucket, are kept apart.
    """
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in key))
    keyed = df.where(whole).repartition(buckets, *key)
    writer = keyed.write.bucketBy(buckets, *key).sortBy(*key).option("path", f"{path}/keyed").mode("overwrite")
    writer.format("parquet").saveAsTable(name)
    write_parquet(df.where(~whole), f"{path}/unkeyed")
    return KeyedTable(name, f"{path}/unkeyed", tuple(key), buckets)


def full_outer_stored(spark: SparkSession, left: KeyedTable, right: KeyedTable) -> DataFrame:
    """FULL OUTER equi-join of two tables stored by the same key: no shuffle, and each is read once."""
    if (left.key, left.buckets) != (right.key, right.buckets):
        raise ValueError(f"tables stored by {left.key} in {left.buckets} and by {right.key} in {right.buckets} buckets")
    shared = (set(left.rows(spark).columns) & set(right.rows(spark).columns)) - set(left.key)
    if shared:
        raise ValueError(f"columns {sorted(shared)} occur on both sides; rename them first")
    matched = left.rows(spark).join(right.rows(spark), list(left.key), "full")
    alone = (t.without_key(spark) for t in (left, right))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alone, matched)
