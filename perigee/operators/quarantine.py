"""Statistics rows the serving tables would refuse, told apart before they are loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.model import StatsTable
from perigee.operators.skew import grouped_lookup

REASON = "reject_reason"


def _row_fault(table: StatsTable) -> Column:
    either = lambda flags: reduce(Column.__or__, flags, F.lit(False))
    null_key = either(F.col(k).isNull() for k in table.key)
    too_long = either(F.length(e) > table.entity_width for e in table.entity)
    overflow = either(
        F.col(m.name).isNotNull() & F.col(m.name).try_cast(m.sql_type).isNull()
        for m in table.measures
    )
    return (
        F.when(null_key, "null_key")
        .when(too_long, "region_too_long")
        .when(overflow, "numeric_overflow")
    )


def quarantine_stats(df: DataFrame, table: StatsTable) -> DataFrame:
    """All rows with ``reject_reason``: NULL if the row may be loaded, else the first of
    null_key, region_too_long, numeric_overflow, duplicate_key that applies.

    Keys count as duplicate among otherwise sound rows, and every copy is marked: a rollup has one row
    per key, so copies mean that something is wrong, and nothing says which came first. Copies are counted
    on the keys alone, with a map-side combine, so a key with very many copies never meets in one task.
    """
    judged = df.withColumn(REASON, _row_fault(table))
    sound = judged.where(F.col(REASON).isNull()).select(*table.key)
    copies = grouped_lookup(sound, table.key, F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    repeated = F.when(F.col("_copies").isNotNull(), "duplicate_key")
    return (
        judged.join(copies, table.key, "left")
        .withColumn(REASON, F.coalesce(F.col(REASON), repeated))
        .select(*df.columns, REASON)
    )


def accepted(quarantined: DataFrame) -> DataFrame:
    return quarantined.where(F.col(REASON).isNull()).drop(REASON)


def rejected(quarantined: DataFrame) -> DataFrame:
    return quarantined.where(F.col(REASON).isNotNull())
