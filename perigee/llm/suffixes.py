"""Repeated byte strings, removed everywhere but where they stand first, by bucket-pointer refinement.

Suffixes need to be sorted only as far as one window. Each has the number of its bucket: at first that of the q-gram
it starts with. Buckets are refined by sorting their suffixes on the numbers of the buckets that hold the suffixes q
bytes later, whichever string and bucket those are in; the new numbers, good for twice the length, are read in the
next round at twice the offset, and so on up to the window's length. A suffix that is alone in its bucket, or whose
later suffix is, occurs once and takes no further part.

Suffixes that can start a repeated window are brought together by the gram that is the minimiser of the windows
around them: the text around it travels as a string, and the suffixes of all strings in a bucket are refined as one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from perigee.llm.windows import Windows, covered, with_runs

BYTES, MINIMISER = 100, 24
#: Bytes of the grams that give the first buckets: their numbers are the grams themselves.
QGRAM = 8
SPEC = Windows(size=BYTES, anchor=MINIMISER, words=False, strict=False, slab=1_000)


def _numbered(keys: np.ndarray, number: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Put into ``number`` the numbers of the buckets of equal keys, for the suffixes ``at`` that share one; return those.

    A key and its place are sorted as one number: keys take at most the bits that places leave.
    """
    bits = np.uint64(len(keys).bit_length())
    packed = (keys.astype(np.uint64) << bits) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    ranked = packed >> bits
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = ranked[1:] != ranked[:-1]
    shared = np.flatnonzero(~(new[:-1] & new[1:]))
    places = (packed[shared] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    number[at[places]] = np.cumsum(new[shared])
    return np.flatnonzero(number)


def refined(tokens: np.ndarray, left: np.ndarray, size: int, qgram: int = QGRAM) -> np.ndarray:
    """For every suffix of ``tokens`` the number of the bucket of its first ``size`` bytes, 0 where no other has the same.

    ``left`` has the bytes from each suffix to the end of its string; a shorter suffix than ``size`` has 0.
    ``qgram`` is at most ``size``; the first grams are shorter if numbers of so many of the bytes that occur are too long.
    """
    used = np.bincount(tokens, minlength=256) > 0
    codes = (np.cumsum(used) - 1).astype(np.uint64)[tokens]
    letters = max(2, int(used.sum()))
    free = 64 - len(tokens).bit_length()
    depth = max(n for n in range(1, qgram + 1) if n == 1 or letters**n <= 1 << free)
    number = np.zeros(len(tokens), np.int64)
    at = np.flatnonzero(left >= depth)
    grams = codes[: len(codes) - depth + 1].copy()
    for k in range(1, depth):
        grams = grams * np.uint64(letters) + codes[k : len(codes) - depth + 1 + k]
    at = _numbered(grams[at], number, at)
    while depth < size and len(at):
        step = min(depth, size - depth)
        at = at[left[at] >= depth + step]
        at = at[number[at + step] > 0]
        most = np.int64(number.max() + 1)
        keys = number[at] * most + number[at + step]
        if 2 * int(most).bit_length() + len(at).bit_length() > 64:
            keys = np.unique(keys, return_inverse=True)[1]
        number = np.zeros(len(tokens), np.int64)
        at = _numbered(keys, number, at)
        depth += step
    return number


def by_refinement(strings, spec, at, anchor, tokens, low, high) -> list[np.ndarray]:
    """Runs that fall among the strings ``at``, which have tokens ``low`` to ``high``, by refining all their suffixes."""
    sizes = high - low
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(at)), sizes)
    inside = np.arange(len(owner)) - begins[owner]
    number = refined(tokens[low[owner] + inside], sizes[owner] - inside, spec.size, min(QGRAM, spec.size))
    window = np.flatnonzero(number)
    ids, starts = strings.ids[at][owner[window]], strings.starts[at][owner[window]] + inside[window]
    order = np.lexsort((starts, ids, number[window]))
    bucket = number[window][order]
    first = np.ones(len(order), bool)
    first[1:] = bucket[1:] != bucket[:-1]
    leader = np.repeat(order[first], np.diff(np.append(np.flatnonzero(first), len(order))))
    late = (ids[order] > ids[leader]) | (starts[order] > starts[leader])
    if spec.strict:
        late = ids[order] > ids[leader]
    falls = np.sort(window[order[late]])
    # windows side by side in one string are one run
    new = np.ones(len(falls) + 1, bool)
    new[1:-1] = (falls[1:] != falls[:-1] + 1) | (owner[falls[1:]] != owner[falls[:-1]])
    cuts = np.flatnonzero(new)
    head = falls[cuts[:-1]]
    row = at[owner[head]]
    return [strings.ids[row], strings.tags[row], strings.starts[row] + inside[head], np.diff(cuts) + spec.size - 1]


def without_repeats(docs: DataFrame, spec: Windows = SPEC) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs`` (doc_id, text).

    A byte of the UTF-8 text is removed if a string of ``spec.size`` bytes covers it that also starts
    earlier: in a document with a smaller doc_id, or earlier in the same one. ``n_spans`` counts maximal
    removed runs; ``kept`` (binary) has the other bytes, which need not be whole characters. Null texts
    count as empty. A null doc_id comes after all others; rows with the same doc_id count as copies of
    one document, so of two repeated rows neither precedes the other. Other columns are not read.
    """

    def finish(doc_id: int | None, text: bytes, runs: list[bytes] | None) -> tuple:
        if not runs:
            return doc_id, len(text), 0, 0, text
        falls = covered(runs, len(text))
        spans = int(np.count_nonzero(falls & ~np.append(False, falls[:-1])))
        return doc_id, len(text), int(falls.sum()), spans, np.frombuffer(text, np.uint8)[~falls].tobytes()

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return with_runs(docs, spec, by_refinement, finish, schema)
