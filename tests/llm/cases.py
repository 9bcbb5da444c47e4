"""Small tables with everything that a real one may hold."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, tag int, key string, "
    "size long, hash long, row string, base string, spans string, copies int, threshold double"
)
EXTRA = (7, 3, "key", 5, 11, "row", "base", "spans", 2, 0.5)


def documents(spark, texts, ids=None, sources=None):
    """Documents with extra columns whose names clash with those the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{i % 3}" for i in range(len(texts))] if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t), *EXTRA) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def texts(seed=1, number=40):
    """Texts that share passages, repeat their own, and the odd ones: null, empty, blank, long, not ASCII."""
    r = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "straße", "año", "o", "漢字", "x" * 40]
    passage = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = [passage(30) for _ in range(4)]
    out = [None, "", " \t\n", "one", "\x0bone\x0ctwo \n three", passage(5000), "ab " * 300, "ab" * 150]
    while len(out) < number:
        parts = [passage(r.randint(0, 25)), r.choice(shared), passage(r.randint(0, 10)), r.choice(shared)]
        out.append(r.choice(["\n", " ", "  "]).join(parts[: r.randint(1, 4)]))
    out[20] = out[21] = out[22]
    return out


def table(spark, seed=1):
    """The texts, with a repeated row and rows without an id."""
    some = texts(seed)
    ids = [*range(len(some)), 5, 30, None, None]
    return documents(spark, [*some, some[5], some[30], some[30], None], ids), some
