"""Helpers for keys that hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPREAD = "_spread"


def grouped_lookup(df: DataFrame, key: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row per key, for use as the right side of a join on ``key``.

    Adaptive execution splits a hot left partition only if both inputs of the join come straight
    from a shuffle. Grouped rows would not: their own shuffle already suits the join. Grouping by
    one more value, derived from the key and so without effect on the groups, makes the join
    shuffle them again, which costs little after they were combined.
    """
    spread = F.pmod(F.hash(*key), F.lit(1024)).alias(_SPREAD)
    grouped = df.select("*", spread).groupBy(*key, _SPREAD)
    return grouped.agg(*aggregates).drop(_SPREAD)
