"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed to a wide vector, and a text's
fingerprint is the sum of the vectors, lane by lane, modulo a power of two: the order of paragraphs does
not matter, and adding or subtracting a paragraph's vector inserts or deletes it. ``CHECK_LANES`` lanes
come from a hash of the whole paragraph and decide equality. ``SKETCH_LANES`` more count, for each bit of
a hash, the word pairs of the paragraph that have it set, and one counts the pairs; the angle between two
such counts tells how alike two texts are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import SEPARATORS, tasks

CHECK_LANES, CHECK_MASK = 8, (1 << 31) - 1
#: Bits of a hash are counted two to a long, in fields that hold the pairs of any text.
FIELDS, FIELD_BITS = 2, 32
SKETCH_LANES = FIELDS * FIELD_BITS
SKETCH_MASK = (1 << 24) - 1


def check_lanes(text: Column) -> Column:
    """For each check lane, the sum of the paragraphs' hashes modulo 2**31."""
    mask = F.lit(CHECK_MASK).cast("long")
    paragraphs = F.split(text, "\n", -1)

    def lane(seed: Column) -> Column:
        add = lambda total, p: (total + F.xxhash64(p, seed).bitwiseAND(mask)).bitwiseAND(mask)
        return F.aggregate(paragraphs, F.lit(0).cast("long"), add)

    return F.transform(F.array(*map(F.lit, range(CHECK_LANES))), lane).cast("array<int>")


def _pairs(text: Column) -> Column:
    """Hashes of each word with the one after it in its paragraph, the last one alone."""
    words = F.transform(F.split(text, "\n", -1), lambda p: F.filter(F.split(p, SEPARATORS, -1), lambda w: w != ""))
    return F.flatten(F.transform(words, lambda ws: F.transform(ws, lambda w, i: F.xxhash64(w, F.get(ws, i + 1)))))


def sketched(rows: DataFrame, text: str, key: list[str]) -> DataFrame:
    """``key, copies, check, sketch`` of each distinct key: keys with equal values have equal texts.

    Pairs are counted where they are read, so one row of sums per text and task is shuffled.
    """
    ones = F.lit(sum(1 << (FIELD_BITS * f) for f in range(FIELDS))).cast("long")
    # two steps: beside the explosion, the check lanes would be taken once per pair
    each = rows.select(*key, check_lanes(F.col(text)).alias("check"), _pairs(F.col(text)).alias("pairs"))
    each = each.select(*key, "check", F.posexplode_outer("pairs").alias("at", "pair"))
    bits = [F.sum(F.shiftrightunsigned("pair", i).bitwiseAND(ones)).alias(f"b{i}") for i in range(FIELD_BITS)]
    first = F.count(F.when(F.coalesce("at", F.lit(0)) == 0, 1)).alias("copies")
    sums = each.groupBy(*key, "check").agg(first, F.count("pair").alias("n"), *bits)
    field = F.lit((1 << FIELD_BITS) - 1).cast("long")
    lanes = [F.shiftright(f"b{i}", FIELD_BITS * f).bitwiseAND(field) for f in range(FIELDS) for i in range(FIELD_BITS)]
    # equal rows were counted together
    each_copy = lambda c: F.pmod(F.call_function("div", F.coalesce(c, F.lit(0)), F.col("copies")), F.lit(SKETCH_MASK + 1))
    sketch = F.array(*map(each_copy, (F.col("n"), *lanes))).cast("array<int>")
    return sums.select(*key, "copies", F.struct("check", sketch.alias("sketch")).alias("vector"))


def text_of(vector_: Column) -> Column:
    """A vector in hexadecimal digits: check lanes, number of pairs, sketch lanes."""
    check = F.transform(vector_["check"], lambda x: F.lpad(F.hex(x), 8, "0"))
    sketch = F.transform(vector_["sketch"], lambda x: F.lpad(F.hex(x), 6, "0"))
    return F.lower(F.array_join(F.concat(check, sketch), ""))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: the cosine of the angle between the centred sketches, 1 for equal fingerprints."""

    def centred(v: Column) -> Column:
        n = F.get(v["sketch"], F.lit(0))
        return F.transform(F.slice(v["sketch"], 2, SKETCH_LANES), lambda x: x.cast("double") * 2 - n)

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda t, p: t + p)

    length = F.sqrt(dot(centred(a), centred(a)) * dot(centred(b), centred(b)))
    cosine = F.when(length > 0, dot(centred(a), centred(b)) / length).otherwise(0.0)
    equal = (a["check"] == b["check"]) & (a["sketch"] == b["sketch"])
    return F.when(equal, 1.0).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def added(a: Column, b: Column) -> Column:
    """The vector of the paragraphs of both: inserts what ``b`` is the vector of."""
    return _together(a, b, lambda x, y: x.cast("long") + y)


def removed(a: Column, b: Column) -> Column:
    """The vector of the paragraphs of ``a`` without those of ``b``, which must be among them."""
    return _together(a, b, lambda x, y: x.cast("long") - y)


def _together(a: Column, b: Column, how: Callable[[Column, Column], Column]) -> Column:
    lanes = lambda name, mask: F.zip_with(a[name], b[name], lambda x, y: how(x, y).bitwiseAND(F.lit(mask).cast("long")).cast("int"))
    return F.struct(lanes("check", CHECK_MASK).alias("check"), lanes("sketch", SKETCH_MASK).alias("sketch"))


#: Bytes of text meant for a range, and shares of a repeated id's rows by which it is dealt to ranges.
RANGE_BYTES, SHARES = 64 << 20, 64
LOWEST = -(1 << 63)


def _dealt_by() -> Column:
    return F.shiftright("tie", 12)


def _bounds(rows: DataFrame) -> list[tuple[int, int, float]]:
    """Bounds of ranges of ``id, tie, salt``: as many as the bytes ask for, at least one for each task.

    An id that fills several ranges is cut by ``tie``, rows that are alike in both by ``salt``. Percentiles are doubles, so
    of ``tie`` only the first 52 bits take part, and ids are those with such a double.
    """
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(tasks(rows.sparkSession), -(-size // RANGE_BYTES))
    found = rows.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)] or [0.5], 10_000)).first()[0]
    times = Counter(found or [])
    heavy = [i for i, n in times.items() if n > 1]
    cut = F.percentile_approx(_dealt_by(), [k / SHARES for k in range(1, SHARES)], 10_000).alias("ties")
    large = rows.filter(F.col("id").cast("double").isin([float(i) for i in heavy]))
    ties = {r["id"]: r["ties"] for r in large.groupBy("id").agg(cut).collect()} if heavy else {}
    bounds = {(i, LOWEST, 0.0) for i in times}
    for i, among in ties.items():
        n = next(n for v, n in times.items() if float(v) == float(i))
        picked = Counter(among[min(len(among), max(1, round(k * SHARES / n))) - 1] for k in range(1, n))
        for tie, alike in picked.items():
            bounds |= {(i, tie, k / alike) for k in range(alike)}
    return sorted(bounds)


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` (``id`` without nulls, ``tie``, ``text``, others) with ``next``, the struct of ``columns`` of the row that
    follows by descending ``id, tie``; the first follows the last.

    Rows are dealt to ranges of id, tie and a salt, and each range also gets the first row of the range below, so no task
    sees more than one range. Rows alike in id and tie are alike in their texts, so any of them may follow the other.
    Bounds and first rows are as many as the ranges.
    """
    rows = rows.withColumn("salt", F.rand(11))
    bounds = _bounds(rows)
    if not bounds:
        return rows.withColumn("next", F.struct(*columns)).drop("salt")
    marks = F.array(*(F.struct(F.lit(i).cast("long").alias("id"), F.lit(t).cast("long").alias("tie"), F.lit(s).alias("salt")) for i, t, s in bounds))
    at = F.size(F.filter(marks, lambda b: b <= F.struct(F.col("id"), _dealt_by().alias("tie"), F.col("salt"))))
    ranged = rows.withColumn("range", at).drop("salt")
    first = ranged.groupBy("range").agg(F.max(F.struct("id", "tie")).alias("top")).collect()  # one row per range
    tops = {r["range"]: tuple(r["top"]) for r in first}
    order = sorted(tops, reverse=True)
    below = zip(order, [*order[1:], *order[:1]], strict=True)
    moves = rows.sparkSession.createDataFrame([(b, *tops[b], above) for above, b in below], "range int, id long, tie long, above int")
    extra = ranged.join(F.broadcast(moves), ["range", "id", "tie"]).dropDuplicates(["range", "id", "tie"])  # a row for each range
    extra = extra.withColumn("range", F.col("above")).select(*ranged.columns)
    both = ranged.withColumn("extra", F.lit(0)).union(extra.withColumn("extra", F.lit(1)))
    by = Window.partitionBy("range").orderBy("extra", F.desc("id"), F.desc("tie"))
    following = both.withColumn("next", F.lead(F.struct(*columns)).over(by))
    return following.filter("extra = 0").drop("extra", "range")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row of ``docs``.

    The edited text has the first half of its code points replaced behind: its last ``n_chars / 2``,
    rounded down, give way to the first as many of the next text (or all of it), by descending doc_id; the
    first follows the last. Null texts count as empty. Null ids come last; rows with equal ids follow each
    other by a hash of their texts. Other columns are not read.
    """
    lowest = F.lit(-(1 << 63)).cast("long")
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, lowest).alias("id"), doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    own = sketched(rows, "text", ["id", "tie"]).select("id", "tie", F.col("vector").alias("own"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - half), F.col("next.text").substr(F.lit(1), half))
    following = with_next(rows, ["id", "tie", "text"]).select(
        "doc_id",
        "id",
        "tie",
        F.col("next.id").alias("next_id"),
        F.col("next.tie").alias("next_tie"),
        F.length("text").cast("long").alias("n_chars"),
        edited.alias("edited"),
    )
    # as bytes, half as long on the way
    following = following.withColumn("edited_sha256", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)))
    key = ["doc_id", "id", "tie", "next_id", "next_tie", "n_chars", "edited_sha256"]
    changed = sketched(following, "edited", key).withColumnRenamed("vector", "changed")
    after = own.select(F.col("id").alias("next_id"), F.col("tie").alias("next_tie"), F.col("own").alias("after"))
    done = changed.join(own, ["id", "tie"]).join(after, ["next_id", "next_tie"])
    done = done.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return done.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        text_of(F.col("own")).alias("fingerprint"),
        text_of(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
    )
