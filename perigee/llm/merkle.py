"""Manifest of a dataset as Merkle trees: one per part, and one over the roots of the parts.

Leaves get their places by range partitioning and counts of ranges, never by a window over a whole part.
On every level the nodes before and after a node come as lag and lead columns of fixed offsets, of which
its slot in the run and the run's length leave its siblings; the first node of a run hashes the parent.
Windows run over blocks of consecutive places, so a part that holds most rows spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import saved, tasks

#: Nodes of a run, which share a parent.
ARITY = 8
#: Consecutive nodes that one window holds, a multiple of ARITY.
BLOCK = 4096
#: Rows of one range when leaves are put in order.
RANGE_ROWS = 1 << 20
#: What a leaf is made of, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def item(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(columns: Mapping[str, Column]) -> Column:
    return F.sha2(F.concat(*(item(c) for c in columns.values())), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_of(path: Column) -> Column:
    """The digest of all siblings on a path, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows``, a table with ``part`` and ``salt``, with ``pos`` and ``n``: a row's place in its part and the part's rows.

    Rows are dealt to ranges of (part, order, salt) and sorted there; counts by range and part, as many rows as
    there are ranges and parts, give each range its first place. Rows equal up to ``salt`` share no task.
    """
    ranges = max(tasks(rows.sparkSession), -(-rows.count() // RANGE_ROWS))
    by = ["part", *order, "salt"]
    spread = rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    spread = saved(spread.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    spread = spread.withColumns({"range": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)})
    counts = spread.groupBy("part", "range").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    part = Window.partitionBy("part")
    upto = F.sum("held").over(part.orderBy("range"))
    counts = saved(counts.select("part", "range", (upto - F.col("held") - F.col("first")).alias("shift"), F.sum("held").over(part).alias("n")), "merkle-ranges")
    return spread.join(counts, ["part", "range"]).withColumn("pos", F.col("at") + F.col("shift")).drop("range", "at", "shift", "salt")


def beside(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``left`` and ``right``: the digests of the run's nodes before and after, joined."""
    window = Window.partitionBy("part", F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = F.pmod("pos", F.lit(ARITY))
    length = F.least(F.lit(ARITY), F.col("n") - F.col("pos") + slot)
    offsets = range(1, ARITY)
    near = {f"lag{k}": F.lag("digest", k).over(window) for k in offsets}
    near |= {f"lead{k}": F.lead("digest", k).over(window) for k in offsets}
    left = F.concat(*(F.when(slot >= k, F.col(f"lag{k}")).otherwise("") for k in reversed(offsets)))
    right = F.concat(*(F.when(slot + k < length, F.col(f"lead{k}")).otherwise("") for k in offsets))
    return nodes.withColumns(near).withColumns({"left": left, "right": right}).drop(*near)


def climbed(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The levels of the trees over ``part, pos, n, digest`` from the leaves up, and ``part, digest`` of the roots.

    A part's last level is the one on which it has a single node.
    """
    most, levels, nodes = leaves.agg(F.max("n")).first()[0] or 0, [], leaves
    while True:
        levels.append(saved(beside(nodes), "merkle-level"))
        if most <= 1:
            break
        first = levels[-1].filter((F.col("n") > 1) & (F.pmod("pos", F.lit(ARITY)) == 0))
        nodes = first.select(
            "part",
            F.floor(F.col("pos") / ARITY).alias("pos"),
            F.ceil(F.col("n") / ARITY).alias("n"),
            F.sha2(F.concat("digest", "right"), 256).alias("digest"),
        )
        most = -(-most // ARITY)
    roots = (level.filter("n = 1").select("part", "digest") for level in levels)
    return levels, reduce(DataFrame.union, roots)


def paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with ``path``, their siblings level by level, and the columns of ``above`` (part, path, ..).

    Paths go down from a parent to its children, so what lies above a run is looked up once for the run.
    """
    more = [c for c in above.columns if c not in ("part", "path")]
    below = None
    for k in reversed(range(len(levels))):
        level = levels[k]
        own = level.columns if k == 0 else ["part", "pos"]
        found = level.filter("n = 1").join(above, "part").select(*own, "path", *more)
        if below is not None:
            step = F.array(F.struct("left", "right"))
            parents = below.select("part", F.col("pos").alias("parent"), F.col("path").alias("upper"), *more)
            inner = level.filter("n > 1").withColumn("parent", F.floor(F.col("pos") / ARITY)).join(parents, ["part", "parent"])
            found = inner.select(*own, F.concat(step, "upper").alias("path"), *more).union(found)
        below = found if k == 0 else saved(found, "merkle-paths")
    return below


def manifest(docs: DataFrame, carried: Mapping[str, Column] | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, path`` for every row of ``docs``, and the ``carried`` columns, made of those of ``docs``.

    Leaves are the rows' doc_id, source, lang, n_chars and text. Each lang is a part, null one of its own and the
    first; within it leaves are in order of doc_id, null first, and of the leaf where ids repeat. ``path`` has, from
    the leaf up to the root, the siblings before and after; ``folded(leaf, path)`` gives the root again. Repeated
    rows are leaves of their own, null and empty texts differ. An empty table has no rows. Other columns are not
    read. The root, one digest, is all that reaches the driver.
    """
    carried = dict(carried or {})
    part = F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0"))
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        part.alias("part"),
        leaf_of({c: F.col(c) for c in LEAF_COLUMNS}).alias("digest"),
        F.monotonically_increasing_id().alias("salt"),
        F.struct(F.lit(None).cast("string").alias("-"), *(c.alias(name) for name, c in carried.items())).alias("carried"),
    )
    levels, subroots = climbed(placed(saved(leaves, "merkle-leaves"), ["doc_id", "digest"]))
    tops = subroots.select(F.lit("").alias("part"), F.col("part").alias("of"), "digest", F.monotonically_increasing_id().alias("salt"))
    top_levels, roots = climbed(placed(saved(tops, "merkle-subroots"), ["of"]))
    root = roots.first()
    start = roots.select("part", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    above = paths(top_levels, start).select(F.col("of").alias("part"), "path", F.col("digest").alias("subroot"))
    found = paths(levels, saved(above, "merkle-above"))
    return found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"),
        "path",
        *(F.col("carried")[name].alias(name) for name in carried),
    )


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def tampered(docs: DataFrame, changed: Column) -> DataFrame:
    """``manifest`` with ``folded_root`` and ``verified``: whether the root follows from the leaf as it would be now, where
    ``changed`` with A to Z of the text in lower case, and the original siblings."""
    after = {c: lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in LEAF_COLUMNS}
    rows = manifest(docs, {"changed_leaf": F.when(changed, leaf_of(after))})
    root = folded(F.coalesce("changed_leaf", "leaf"), F.col("path"))
    return rows.withColumn("folded_root", root).withColumn("verified", F.col("folded_root") == F.col("root"))
