"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is a stretch of twice as many words as the longest template may have, and blocks overlap by half, so every
stretch of that many words lies within a block. A block has a template if it contains a given share of the
template's distinct words. Which do is found by a join: words are put in one global order, the rarest first; if
block and template share as many words as needed, the smallest shared word is in the prefix of both, so it is
enough to join prefixes, to drop blocks that have too few words, and pairs whose places in both leave too few words
to come. What passes is counted out. Only words that templates have can be shared, so blocks are made of those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import saved
from perigee.llm.merkle import lower_ascii

#: What separates words of a text in its own letters, as a Java pattern; and the characters that words are made of.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
INSIDE = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
# The phrases with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Sentences of widespread licenses with their labels.
TEMPLATES = (
    ("mit", "released under the MIT license"),
    ("mit", "licensed under the MIT license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the Software to deal in the Software without restriction",
    ),
    ("apache-2.0", "licensed under the Apache License Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License you may obtain a copy of the License at"),
    ("gpl", "licensed under the GNU General Public License version"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl", "under the terms of the GNU Affero General Public License"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    ("mpl-2.0", "this Source Code Form is subject to the terms of the Mozilla Public License v 2.0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under a Creative Commons Attribution license"),
    ("cc-by-nc", "licensed under CC BY NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial license"),
    ("cc-by-sa", "licensed under CC BY SA 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike license"),
    ("cc-by-nd", "licensed under CC BY ND 4.0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("proprietary", "no part of this publication may be reproduced without the prior written permission of the publisher"),
)
#: Share of a template's distinct words that a block must contain.
CONTAINED = 0.9
#: Words by which blocks move on; they are twice as long, and no template is longer than this.
STEP = 40


def words_of(text: Column) -> Column:
    """The words of a text in its own letters; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN, -1), "")


def _lower(word: Column) -> Column:
    """A word with A to Z in lower case, letter by letter only where it has others than ASCII."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(lower_ascii(word))


def template_words(templates: Sequence[tuple[str, str]]) -> list[tuple[int, str, list[str]]]:
    """Number, label and distinct words of each template."""
    lower = {c: (chr(c).lower() if chr(c).isalnum() else " ") for c in range(128)}
    split = [(label, [w for w in text.translate(lower).split(" ") if w]) for label, text in templates]
    if any(not 0 < len(words) <= STEP for _, words in split):
        raise ValueError(f"templates must have 1 to {STEP} words")
    return [(k, label, sorted(set(words))) for k, (label, words) in enumerate(split)]


def needed(number: int, contained: float) -> int:
    """The least whole number of shared words that is the share ``contained`` of ``number``."""
    return next(n for n in range(1, number + 1) if n / number >= contained)


def _places(words: Column, phrases: Mapping[str, str]) -> Column:
    """``at, label`` of every place where a phrase's words stand one after the other."""

    def of(phrase: str, label: str) -> Column:
        parts = phrase.split()
        # the words and those that follow side by side, so that no place looks back into the whole array
        ahead = F.arrays_zip(*(F.slice(words, k + 1, F.size(words)).alias(f"w{k}") for k in range(len(parts))))
        hit = lambda z: reduce(lambda a, b: a & b, (F.coalesce(z[f"w{k}"] == p, F.lit(False)) for k, p in enumerate(parts)))
        found = F.transform(ahead, lambda z, i: F.when(hit(z), F.struct(i.cast("long").alias("at"), F.lit(label).alias("label"))))
        return F.filter(found, lambda f: f.isNotNull())

    return F.array_sort(F.concat(*(of(p, label) for p, label in phrases.items())))


def _frequencies(read: DataFrame) -> dict[str, int]:
    """Texts that have each of the templates' words: as many rows as those have words, whatever the texts."""
    counted = read.select(F.explode(F.array_distinct("marks.word")).alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in counted.collect()}


def _ranked(templates: list[tuple[int, str, list[str]]], often: Mapping[str, int]) -> tuple[dict[str, int], dict[int, list[int]]]:
    """The global order of the words, the rarest first, and the words of each template as numbers in that order."""
    known = sorted({w for _, _, words in templates for w in words}, key=lambda w: (often.get(w, 0), w))
    rank = {w: k for k, w in enumerate(known)}
    return rank, {k: sorted(rank[w] for w in words) for k, _, words in templates}


def _blocks(marks: DataFrame, least: int) -> DataFrame:
    """``row, block, size, ranks`` of the blocks with at least ``least`` template words, for rows ``row, at, rank``."""
    step = F.floor(F.col("at") / STEP)
    both = F.when(step > 0, F.array(step - 1, step)).otherwise(F.array(step))
    sets = marks.select("row", "rank", F.explode(both).alias("block")).groupBy("row", "block")
    blocks = sets.agg(F.array_sort(F.collect_set("rank")).alias("ranks"))  # at most the templates' words
    return blocks.withColumn("size", F.size("ranks")).filter(F.col("size") >= least)


def matches(marks: DataFrame, ranked: dict[int, list[int]], contained: float) -> DataFrame:
    """``row, block, template, share`` of every block and template that meet ``contained``, for rows ``row, at, rank``."""
    spark = marks.sparkSession
    need = {k: needed(len(r), contained) for k, r in ranked.items()}
    prefixes = [
        (rank, k, place, len(ranks), need[k], ranks)
        for k, ranks in ranked.items()
        for place, rank in enumerate(ranks[: len(ranks) - need[k] + 1])
    ]
    # as long as the templates, which are a parameter
    index = spark.createDataFrame(prefixes, "rank int, template int, there int, words int, need int, of array<int>")
    blocks = _blocks(marks, min(need.values()))
    heads = blocks.select("row", "block", "size", "ranks", F.posexplode(F.slice("ranks", F.lit(1), F.col("size") - min(need.values()) + 1)).alias("here", "rank"))
    left = F.least(F.col("size") - F.col("here"), F.col("words") - F.col("there"))
    pairs = heads.join(F.broadcast(index), "rank").filter(
        (F.col("size") >= F.col("need")) & (F.col("here") <= F.col("size") - F.col("need")) & (left >= F.col("need"))
    )
    shared = F.size(F.array_intersect("ranks", "of"))
    share = shared / F.col("words")
    verified = pairs.filter(shared >= F.col("need")).select("row", "block", "template", share.alias("share"))
    return verified.distinct()  # a pair may share several words of its prefixes


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    contained: float = CONTAINED,
) -> DataFrame:
    """``doc_id, n_words, places, blocks`` for every row of ``docs`` (doc_id, text).

    ``places`` has ``at, label`` of each place where a phrase stands, ``blocks`` has ``block, template, label, share`` of
    each block that meets the template: block b is words 40 b to 40 b + 79. Words are runs of letters and digits,
    A to Z in lower case, and everything beyond ASCII. Null texts count as empty and have neither. Repeated rows and rows
    without an id get the results of their own text. Other columns are not read.
    """
    numbered = template_words(templates)
    known = sorted({w for _, _, words in numbered for w in words})
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), words_of(text).alias("words"))
    apart = "|".join(BETWEEN.join(p.split()) for p in phrases)
    places = F.when(F.col("text").rlike(f"(?i)(?<!{INSIDE})(?:{apart})(?!{INSIDE})"), _places(F.transform("words", _lower), phrases))
    none = F.array().cast("array<struct<at:bigint,label:string>>")
    spelled = F.transform("words", lambda w, i: F.when(_lower(w).isin(known), F.struct(i.alias("at"), _lower(w).alias("word"))))
    read = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        (F.coalesce(places, none) if phrases else none).alias("places"),
        F.filter(spelled, lambda m: m.isNotNull()).alias("marks"),
    )
    read = saved(read, "license-rows")  # texts are read once; this also fixes the numbers of the rows
    rank, ranked = _ranked(numbered, _frequencies(read))
    # the rarest words of the templates, without one of which no block has any of them
    rare = {r for ranks in ranked.values() for r in ranks[: len(ranks) - needed(len(ranks), contained) + 1]}
    worth = F.arrays_overlap("marks.word", F.array(*(F.lit(w) for w in sorted(w for w, r in rank.items() if r in rare))))
    number = F.create_map(*(F.lit(v) for pair in rank.items() for v in pair))
    marked = read.filter(worth).select("row", F.inline("marks")).select("row", "at", number[F.col("word")].alias("rank"))
    labels = spark.createDataFrame([(k, label) for k, label, _ in numbered], "template int, label string")
    found = matches(marked, ranked, contained).join(F.broadcast(labels), "template")
    found = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("block", "template", "label", "share"))).alias("blocks"))
    empty = F.array().cast("array<struct<block:bigint,template:int,label:string,share:double>>")
    return read.join(found, "row", "left").select("doc_id", "n_words", "places", F.coalesce("blocks", empty).alias("blocks"))


def summary(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of ``scan``.

    The score is the largest share of a template that a block contains, 1 where a phrase stands, 0 for texts with neither.
    """
    rows = scan(docs, **options)
    named = lambda c: F.array_distinct(F.transform(c, lambda x: x["label"]))
    listed = lambda c: F.array_join(F.array_sort(c), ",")
    starts = F.transform("places", lambda p: p["at"])
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["share"])), F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(named("places")).alias("base_labels"),
        listed(F.array_distinct(F.concat(named("places"), named("blocks")))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )
