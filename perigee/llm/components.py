"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every end of an edge ``a, b``: component is its smallest node.

    Large-star and small-star steps alternate until the edges stay as they are: each step is a
    combinable minimum by node and a join that adaptive execution may split, so neither a giant
    component nor a node with very many edges gathers in one task. Every round is written to the
    shared folder. Self links, repeated and reversed edges are harmless; edges with a null end are left out.
    """
    ordered = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    current = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(*ordered).distinct()
    current, before = saved(current, "components"), None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        current = saved(_small_star(_large_star(current)), "components")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
