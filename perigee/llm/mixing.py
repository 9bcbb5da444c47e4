"""Mixing sources to target weights with hash thresholds.

A source is taken a whole number of times, and once more from the documents whose hash lies below the
source's threshold. The threshold comes from a histogram of words by source and hash range: the ranges
below the budget are taken whole, and only the range in which the budget ends is looked at more finely,
until it holds a single hash value. Then one filter decides, without sorting documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import saved, word_count
from perigee.llm.merkle import placed

#: Weights of the sources in code-point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: A target stops at so many times its source's size.
MOST = 3
#: Bits of the hash, and of one level of the histogram.
HASH_BITS, LEVEL_BITS = 60, 10
#: Nested budgets of a source, and the share of one that a document of the next may have at most.
ROUNDS, SHORT = 3, 6


def _size_and_hash() -> tuple[Column, Column]:
    bits = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long"), F.length("text")), 64 - HASH_BITS)
    return word_count(F.col("text")), bits


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, hash``: words of each row and 60 bits of a hash of its doc_id and text length."""
    size, bits = _size_and_hash()
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), bits.alias("hash"))


def targets(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` for rows with ``source, size``: one row per source.

    Targets share ``share`` of all words by weight; where one passes ``most`` times its source's size it
    stops there and the excess goes to the others by weight, again until none is above. Only sums over
    the sources reach the driver. Sources get their numbers from ranges of them and counts of the ranges.
    """
    each = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # in order of code points, null last
    order = F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1")).alias("order")
    each = saved(each.select("*", F.lit("").alias("part"), order, F.monotonically_increasing_id().alias("salt")), "source-sizes")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("pos") % len(weights)).cast("int") + 1)
    each = saved(placed(each, ["order"]).select("source", "source_size", weight.alias("weight")), "sources")
    total = (each.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped = 0.0, -1
    limit = F.col("source_size") * float(most)
    while True:
        over = F.col("weight") * level >= limit
        state = each.agg(
            F.count(F.when(over, 1)), F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if state[0] == stopped or state[2] is None:
            break
        stopped, level = state[0], (total - (state[1] or 0.0)) / state[2]
    return each.select("source", "source_size", F.least(F.col("weight") * level, limit).alias("target"))


def _cut(rows: DataFrame, budgets: DataFrame, last: bool) -> DataFrame:
    """``source, threshold, rest`` for ``budgets`` with ``source, budget, least, limit``.

    Of the rows with ``hash >= least`` and ``size <= limit``, those below ``threshold`` come to ``budget``
    less ``rest``. Each level reads only rows in the ranges in which a budget ends, about a thousandth of
    the level before. The last range, a single hash value, is taken if it fits or, where ``last``, if
    that comes nearer.
    """
    open_, done = budgets.withColumn("low", F.lit(0).cast("long")), None
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - LEVEL_BITS * level
        width = F.lit(1 << (shift + LEVEL_BITS)).cast("long")
        o = open_.withColumnRenamed("source", "open_source")
        inside = (F.col("hash") >= F.col("low")) & (F.col("hash") < F.col("low") + width)
        inside &= (F.col("hash") >= F.col("least")) & (F.col("size") <= F.col("limit"))
        joined = rows.join(o, rows.source.eqNullSafe(o.open_source)).filter(inside)
        part = F.shiftright(F.col("hash") - F.col("low"), shift)
        key = ["source", "budget", "least", "limit", "low"]
        histogram = joined.groupBy(*key, part.alias("part")).agg(
            F.sum("size").alias("here"), F.min("hash").alias("first"), F.max("hash").alias("final")
        )
        upto = F.sum("here").over(Window.partitionBy("source").orderBy("part"))
        top = F.max("part").over(Window.partitionBy("source"))
        ranges = histogram.withColumn("upto", upto).withColumn("top", top)
        rest = F.col("budget") - F.col("upto") + F.col("here")
        ends = (F.col("upto") > F.col("budget")) & (rest >= 0)
        edge = ranges.filter(ends | ((F.col("part") == F.col("top")) & (F.col("upto") <= F.col("budget"))))
        edge = edge.withColumn("budget", rest).withColumn("low", F.col("low") + F.col("part") * F.lit(1 << shift))
        edge = saved(edge.withColumn("single", F.col("first") == F.col("final")), "mix-edges")
        take = F.col("budget") >= F.col("here") / (2 if last else 1)
        ready = edge.filter("single").select(
            "source",
            F.when(take, F.col("final") + 1).otherwise(F.greatest("least", "low")).alias("threshold"),
            (F.col("budget") - F.when(take, F.col("here")).otherwise(0)).alias("rest"),
        )
        done = ready if done is None else done.union(ready)
        open_ = edge.filter("NOT single").select(*key)
        if open_.isEmpty():
            break
    found = done.withColumnRenamed("source", "done_source")
    kept = budgets.join(found, budgets.source.eqNullSafe(found.done_source), "left")
    return kept.select(
        "source", F.coalesce("threshold", "least").alias("threshold"), F.coalesce("rest", "budget").alias("rest")
    )


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``source, source_size, target, whole, cuts``: times to take a source whole, and nested budgets: a row of
    ``rows`` is taken once more if for one of ``cuts`` it is at most ``limit`` long and its hash below ``threshold``.

    The first budget is what the target leaves over whole copies. What the documents below its threshold
    leave of it, less than one document, is the budget of short documents above the threshold, and so on.
    """
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).cast("long")
    state = wanted.withColumn("whole", times).withColumn("cuts", F.array().cast("array<struct<limit:long,threshold:long>>"))
    state = state.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    state = state.withColumn("least", F.lit(0).cast("long")).withColumn("limit", F.lit((1 << 62)).cast("long"))
    for turn in range(ROUNDS):
        cut = _cut(rows, state.select("source", "budget", "least", "limit"), turn == ROUNDS - 1)
        cut = cut.withColumnRenamed("source", "cut_source")
        state = state.join(cut, state.source.eqNullSafe(cut.cut_source)).select(
            "source",
            "source_size",
            "target",
            "whole",
            # nothing left to spend takes nothing more, empty texts neither
            F.concat("cuts", F.array(F.struct("limit", F.when(F.col("budget") > 0, F.col("threshold")).otherwise(0).alias("threshold")))).alias("cuts"),
            F.col("rest").alias("budget"),
            F.col("threshold").alias("least"),
            F.floor(F.col("rest") / SHORT).cast("long").alias("limit"),
        )
        state = saved(state, "mix-plan")
    return state.drop("budget", "least", "limit")


def _planned(docs: DataFrame, weights: tuple[float, ...], share: float, most: float) -> tuple[DataFrame, DataFrame]:
    """Sizes of the rows, and the plan of each source."""
    rows = saved(sizes(docs), "sizes")
    return rows, thresholds(rows, targets(rows, weights, share, most)).withColumnRenamed("source", "plan_source")


def _copies() -> Column:
    more = F.exists("cuts", lambda c: (F.col("size") <= c["limit"]) & (F.col("hash") < c["threshold"]))
    return F.col("whole") + more.cast("int")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs`` (doc_id, text, source).

    ``copies`` says how often the mix has the row, at most ``most`` rounded up; ``taken`` is that times its
    size. Sources without any words are taken once. The choice depends on the data alone, so reruns agree. Null is a source of its own, the last one;
    null and empty texts have size 0. Rows with the same doc_id and length, repeated rows too, share their
    fate. A null doc_id is hashed like any value. Other columns are not read.
    """
    rows, plan = _planned(docs, weights, share, most)
    joined = rows.join(plan, rows.source.eqNullSafe(plan.plan_source)).withColumn("copies", _copies())
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return joined.select("doc_id", "source", "size", "source_size", "target", "copies", taken)


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = MOST) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix has them."""
    size, bits = _size_and_hash()
    rows = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("of"), size.alias("size"), bits.alias("hash"))
    _, plan = _planned(docs, weights, share, most)
    joined = rows.join(plan, rows.of.eqNullSafe(plan.plan_source)).select("row", _copies().cast("int").alias("copies"))
    return joined.filter("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
