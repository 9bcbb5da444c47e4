"""Personal data: base patterns, and identifiers found by patterns that those induce.

The four kinds of base spans are regular expressions with a check of the digits. They are the seeds of a
bootstrap: the words before and after a seed are lexical patterns. Patterns and the words they stand next
to form a graph, which is scored by turns: a pattern is as trustworthy as its instances, an instance as
its patterns. Words with the look of an identifier that a trusted pattern stands next to are personal
data too, though no base pattern knows them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perigee.llm.common import saved

#: Kinds in the order in which spans with the same start are listed; bootstrapped spans come last.
KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
# The base patterns. Quantifiers are possessive, where that changes no match, so that long
# runs cost neither stack nor time; a match starts at the start of a run or at the end of the match before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a pattern to be worth looking for.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
#: Words before and after an instance that make a pattern.
BEFORE, AFTER = 2, 1
#: Turns of scoring, instances a pattern needs, and the score that makes it trusted.
TURNS, LEAST_INSTANCES, TRUSTED = 3, 3, 0.6
#: The look of an identifier: a word with at least four digits or with an at sign.
LOOK = r"[0-9][^0-9]*[0-9][^0-9]*[0-9][^0-9]*[0-9]|[^@]@[^@]"
SPACE = r"[\x20\x09-\x0D]+"


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.length(digits).between(12, 19) & _luhn(digits)


def _luhn(digits: Column) -> Column:
    """The check of card numbers: from the right, every other digit doubled, digit sums add up to a multiple of ten."""
    ones = F.transform(F.split(F.reverse(digits), ""), lambda c: F.when(c == "", 0).otherwise(c.cast("int")))
    twice = F.transform(ones, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(twice, F.lit(0), lambda t, d: t + d) % 10 == 0


def _matches(texts: DataFrame, kind: str) -> DataFrame:
    """``key, start, end, kind, match`` of every valid match in ``key, text``; positions in code points, end exclusive.

    Matches become rows, with the text between a match and the one before as a length, so where a match starts is a
    running sum and a text takes time in proportion to its matches.
    """
    pattern, text = PATTERNS[kind], F.col("text")
    has = F.instr(text, NEEDS[kind]) > 0 if kind == "email" else text.rlike(NEEDS[kind])
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("match")), lambda p: p["match"].isNotNull())
    rows = texts.filter(has).select("key", F.posexplode(pairs).alias("at", "pair")).select("key", "at", "pair.*")
    upto = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto).cast("int"))
    start = (F.col("end") - F.length("match")).alias("start")
    return rows.filter(_valid(kind, F.col("match"))).select("key", start, "end", F.lit(KINDS.index(kind)).alias("kind"), "match")


def base_spans(texts: DataFrame) -> DataFrame:
    """``key, start, end, kind, match`` of the valid base spans of ``key, text``, a row for each."""
    return reduce(DataFrame.union, (_matches(texts, kind) for kind in KINDS))


def _candidates(docs: DataFrame) -> DataFrame:
    """``key, word, start, end, before, after`` for words with the look of an identifier, for rows ``key, text``.

    Words become rows, so a text of any length takes time in proportion to it. A part is a word with the
    space before it; marks around a word are left out of its span.
    """
    parts = F.regexp_extract_all(F.col("text"), F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), 1)
    rows = docs.select("key", F.posexplode(parts).alias("at", "part"))
    rows = rows.withColumn("word", F.regexp_replace("part", f"^{SPACE}", ""))
    core = F.regexp_replace(F.lower("word"), "[^\\p{L}]+", "")
    by = Window.partitionBy("key").orderBy("at")
    begins = F.coalesce(F.sum(F.length("part")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("core", core).select(
        "key",
        "word",
        (begins + F.length("part") - F.length("word")).cast("int").alias("at"),
        F.concat_ws(" ", *(F.lag("core", k).over(by) for k in range(BEFORE, 0, -1))).alias("before"),
        F.concat_ws(" ", *(F.lead("core", k).over(by) for k in range(1, AFTER + 1))).alias("after"),
    )
    rows = rows.where(F.col("word").rlike(LOOK))
    headless = F.regexp_replace("word", "^[\\p{P}\\p{S}&&[^+]]+", "")
    trimmed = F.regexp_replace(headless, "[\\p{P}\\p{S}]+$", "")
    start = F.col("at") + F.length("word") - F.length(headless)
    return rows.select(
        "key", trimmed.alias("word"), start.alias("start"), (start + F.length(trimmed)).alias("end"), "before", "after"
    ).where("end > start")


def _seeds(words: DataFrame, base: DataFrame) -> DataFrame:
    """``words`` with ``seed``: whether a base span of the same text shares a place with the word.

    In order of place, a span at its start and a word at its end, a word shares a place with some span if one of those
    before reaches beyond the word's start.
    """
    spans = base.select("key", F.col("start").alias("place"), F.col("end").alias("reach"))
    placed = words.select("*", (F.col("end") - 1).alias("place"), F.lit(None).cast("int").alias("reach"))
    both = placed.unionByName(spans, allowMissingColumns=True)
    before = Window.partitionBy("key").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reached = both.withColumn("reached", F.max("reach").over(before)).filter("word IS NOT NULL")
    return reached.select(*words.columns, F.coalesce(F.col("reached") > F.col("start"), F.lit(False)).alias("seed"))


def bootstrapped(texts: DataFrame, base: DataFrame) -> DataFrame:
    """``key, start, end, kind, match``: identifiers next to trusted patterns, for texts ``key, text`` and their base spans."""
    words = saved(_candidates(texts.where(F.col("text").rlike(LOOK))), "pii-candidates")
    words = _seeds(words, base)
    sides = F.array(F.concat(F.lit("<"), "before"), F.concat(F.lit(">"), "after"))
    words = words.select("key", "word", "start", "end", "seed", sides.alias("sides"))
    words = words.select("key", "word", "start", "end", "seed", F.explode("sides").alias("pattern"))
    words = saved(words.where("length(trim(substring(pattern, 2))) > 0"), "pii-words")
    trusted = saved(_trusted_patterns(words), "pii-patterns")
    hits = words.filter("NOT seed").join(trusted, "pattern", "left_semi")
    return hits.select("key", "start", "end", F.lit(len(KINDS)).alias("kind"), F.col("word").alias("match")).distinct()


def _trusted_patterns(words: DataFrame) -> DataFrame:
    """``pattern`` of those whose score ends above ``TRUSTED``.

    A seed instance scores 1, others 0 at first. Each turn a pattern gets the mean score of its distinct
    instances and an instance that is no seed the best of its patterns, damped by half. Edges are
    distinct pairs, so a passage with many copies counts once; both steps are combinable aggregates.
    """
    edges = words.groupBy("pattern", "word").agg(F.max(F.col("seed").cast("double")).alias("seed"))
    often = edges.groupBy("pattern").count().filter(F.col("count") >= LEAST_INSTANCES).select("pattern")
    edges = saved(edges.join(often, "pattern"), "pii-edges")
    scored = edges.groupBy("word").agg(F.max("seed").alias("score"))
    for turn in range(TURNS):
        patterns = edges.join(scored, "word").groupBy("pattern").agg(F.avg("score").alias("trust"))
        if turn < TURNS - 1:
            better = edges.join(patterns, "pattern").groupBy("word").agg(F.max("seed").alias("seed"), F.max("trust").alias("trust"))
            scored = better.select("word", F.greatest("seed", F.col("trust") * 0.5).alias("score"))
            scored = saved(scored, "pii-scores")
    return patterns.filter(F.col("trust") >= TRUSTED).select("pattern")


#: Type of a list of spans; the order of the fields is that of the spans.
SPANS = "array<struct<start:int,kind:int,end:int,match:string>>"


def _key() -> Column:
    """128 bits of a row's doc_id and text: spans are those of the text."""
    return F.md5(F.concat_ws("-", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.coalesce("text", F.lit(""))))


def _spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, text`` of the texts that may have personal data, and ``key, start, end, kind, match`` of all spans in them."""
    some = docs.filter(F.col("text").rlike("[0-9@]")).select(_key().alias("key"), "text").dropDuplicates(["key"])
    some = saved(some, "pii-texts")
    base = saved(base_spans(some), "pii-base")
    return some, saved(base.union(bootstrapped(some, base)), "pii-spans")


def personal_data(docs: DataFrame, columns: Sequence[str] = ("*",)) -> DataFrame:
    """``row, base, spans`` for every row of ``docs``: its columns, the base spans, and all spans, by start and kind.

    Only the given columns are kept and moved; whoever needs the spans alone saves moving the texts.

    A span is ``start, end, kind, match`` with the kind's number; positions are code points, end exclusive.
    Null texts count as empty. Rows are told apart by doc_id and text, so rows with equal ids, repeated rows
    and null ids get the spans of their own text. The spans of one text make one array.
    """
    none = F.array().cast(SPANS)
    span = F.struct("start", "kind", "end", "match")
    _, found = _spans(docs)
    known = found.groupBy("key").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    rows = docs.select(F.struct(*columns).alias("row"), _key().alias("row_key"))
    joined = rows.join(known, F.col("row_key") == F.col("key"), "left").select("row", F.coalesce("spans", none).alias("spans"))
    return joined.select("row", F.filter("spans", lambda s: s["kind"] < len(KINDS)).alias("base"), "spans")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _names() -> Column:
    return F.array(*map(F.lit, (*KINDS, FOUND)))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    one = lambda s: F.concat_ws(":", F.get(_names(), s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


#: Code points of a text that are redacted together.
BLOCK = 4096


def _redacted_texts(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``key, clean`` of the texts that have spans.

    Spans that share places with one before are part of it. Texts are cut in blocks and blocks put together again, so a
    text takes time in proportion to its length and its spans.
    """
    by = Window.partitionBy("key").orderBy("start", "kind", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    heads = spans.withColumn("head", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("long"))
    heads = heads.withColumn("group", F.sum("head").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    first = F.max(F.when(F.col("head") == 1, F.col("kind")))
    whole = heads.groupBy("key", "group").agg(F.min("start").alias("start"), F.max("end").alias("end"), first.alias("kind"))
    block = lambda c: F.floor(c / BLOCK).cast("int")
    cut = whole.select("*", F.explode(F.sequence(block(F.col("start")), block(F.col("end") - 1))).alias("block"))
    origin = F.col("block") * BLOCK
    mark = F.when(block(F.col("start")) == F.col("block"), F.concat(F.lit("["), F.get(_names(), F.col("kind")), F.lit("]"))).otherwise("")
    low, high = F.greatest(F.col("start") - origin, F.lit(0)), F.least(F.col("end") - origin, F.lit(BLOCK))
    cut = cut.groupBy("key", "block").agg(F.array_sort(F.collect_list(F.struct(low.alias("low"), high.alias("high"), mark.alias("mark")))).alias("cuts"))
    some = texts.join(spans.select("key").distinct(), "key", "left_semi")
    parts = F.regexp_extract_all("text", F.lit(f"(?s)(.{{1,{BLOCK}}})"), 1)
    blocks = some.select("key", F.posexplode(parts).alias("block", "part")).join(cut, ["key", "block"], "left")

    def add(state: Column, c: Column) -> Column:
        between = F.substring(F.col("part"), state["at"] + 1, c["low"] - state["at"])
        return F.struct(c["high"].alias("at"), F.concat(state["text"], between, c["mark"]).alias("text"))

    rest = lambda s: F.concat(s["text"], F.substring(F.col("part"), s["at"] + 1, F.lit(BLOCK)))
    clean = F.coalesce(F.aggregate("cuts", F.struct(F.lit(0).alias("at"), F.lit("").alias("text")), add, rest), F.col("part"))
    ordered = F.array_sort(F.collect_list(F.struct("block", clean.alias("part"))))
    return blocks.groupBy("key").agg(F.array_join(F.transform(ordered, lambda b: b["part"]), "").alias("clean"))


def redacted(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with every span of personal data replaced by its kind in brackets; ``n_chars`` follows."""
    texts, spans = _spans(docs)
    known = _redacted_texts(texts, spans)
    rows = docs.select(F.struct("*").alias("row"), _key().alias("row_key"))
    rows = rows.join(known, F.col("row_key") == F.col("key"), "left").select("row", "clean")
    changed = {"text": F.coalesce("clean", F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("clean").isNotNull(), F.length("clean").cast(kind)).otherwise(F.col("row.n_chars"))
    return rows.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
