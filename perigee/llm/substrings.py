"""Repeated passages of words, removed from all but the first document that has them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from perigee.llm.windows import Windows, by_sides, covered_with_repeats, with_runs

#: Words of a window, and of the minimiser that decides where it is counted.
WORDS, MINIMISER = 13, 4
SPEC = Windows(size=WORDS, anchor=MINIMISER, words=True, strict=True)


def without_repeats(docs: DataFrame, spec: Windows = SPEC) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row of ``docs`` (doc_id, text).

    A word is removed if a window of ``spec.size`` words covers it whose words also stand in a document
    with a smaller doc_id. ``kept`` has the other words joined by one blank. Null and empty texts have no
    words. A null doc_id comes after all others; rows with the same doc_id, repeated rows too, remove
    nothing from each other. Other columns are not read.
    """

    def finish(doc_id: int | None, text: bytes, runs: list[bytes] | None) -> tuple:
        words, removed = text.split(), 0
        n = len(words)
        if runs:
            falls = covered_with_repeats(runs, words, spec.size)
            removed = int(falls.sum())
            words = [words[i] for i in np.flatnonzero(~falls).tolist()]
        return doc_id, n, removed, b" ".join(words).decode()

    schema = "doc_id long, n_words long, n_removed long, kept string"
    return with_runs(docs, spec, by_sides, finish, schema)
