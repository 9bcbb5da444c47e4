"""Operators 1 and 5 against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from tests_llm_cases import documents, table, texts

from perigee.llm import substrings, suffixes, windows
from perigee.llm.windows import Windows

LAST = 1 << 63


def falls(sequences, size, strict):
    """By row: which tokens fall. Sequences are (id or None, tokens); equal ids do not precede each other."""
    first = {}
    order = [LAST if i is None else i for i, _ in sequences]
    for i, (_, tokens) in sorted(zip(order, sequences, strict=True), key=lambda x: x[0]):
        for k in range(len(tokens) - size + 1):
            at = first.setdefault(tuple(tokens[k : k + size]), (i, k))
            first[tuple(tokens[k : k + size])] = min(at, (i, k))
    out = []
    for i, (_, tokens) in zip(order, sequences, strict=True):
        mask = np.zeros(len(tokens), bool)
        for k in range(len(tokens) - size + 1):
            a, b = first[tuple(tokens[k : k + size])]
            if a < i or (not strict and (a, b) < (i, k)):
                mask[k : k + size] = True
        out.append(mask)
    return out


def check_words(df):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    tokens = [(i, (t or "").encode().split()) for i, t in rows]
    expected = [
        (i, len(w), int(m.sum()), b" ".join(x for x, f in zip(w, m, strict=True) if not f).decode())
        for (i, w), m in zip(tokens, falls(tokens, 13, True), strict=True)
    ]
    got = [tuple(r) for r in substrings.without_repeats(df).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def check_bytes(df):
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    data = [(i, (t or "").encode()) for i, t in rows]
    expected = []
    for (i, b), m in zip(data, falls(data, 100, False), strict=True):
        spans = int((m & ~np.append(False, m[:-1])).sum()) if len(m) else 0
        expected.append((i, len(b), int(m.sum()), spans, bytes(x for x, f in zip(b, m, strict=True) if not f)))
    got = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffixes.without_repeats(df).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("check", [check_words, check_bytes])
def test_equals_brute_force_on_odd_rows(spark, check):
    check(table(spark)[0].repartition(3))


@pytest.mark.parametrize("check", [check_words, check_bytes])
def test_small_buckets_blocks_and_heavy_anchors_change_nothing(spark, check, monkeypatch):
    for name, value in (("BUCKET_BYTES", 4000), ("FLUSH_BYTES", 3000), ("SLAB_ROWS", 5), ("HEAVY_SHARE", 0.0)):
        monkeypatch.setattr(windows, name, value)
    monkeypatch.setattr(windows, "BLOCK_BYTES", 8192)
    common = " ".join(f"w{i}" for i in range(14))
    some = [f"{'a' * (i % 7)} {i} {common} {i * 7} z{i}" for i in range(150)] + texts(2)
    check(documents(spark, some).repartition(4))


@pytest.mark.parametrize("seed", range(40))
def test_refined_buckets_are_those_of_equal_windows_in_their_order(seed):
    some = np.random.default_rng(seed)
    size, qgram = int(some.choice([8, 9, 33, 100])), int(some.choice([1, 3, 8]))
    strings = [bytes(some.choice([0, 97, 255], n).astype(np.uint8)) for n in some.integers(0, 60, 6)] + [b"a" * int(some.integers(0, 250))] * 2
    data = b"".join(strings)
    left = np.concatenate([np.arange(len(s), 0, -1) for s in strings])
    number = suffixes.refined(np.frombuffer(data, np.uint8), left, size, qgram)
    found = [data[i : i + size] if left[i] >= size else None for i in range(len(data))]
    twice = {w for w in found if w is not None and found.count(w) > 1}
    names = dict(zip(found, number.tolist(), strict=True))
    assert [n > 0 for n in number] == [w in twice for w in found]
    assert all(names[w] == n for w, n in zip(found, number, strict=True) if w in twice)
    assert sorted(twice) == sorted(twice, key=names.get) and len({names[w] for w in twice}) == len(twice)


@pytest.mark.parametrize("check", [check_words, check_bytes])
def test_empty_table(spark, check):
    check(documents(spark, []))


def test_hashes_of_grams_and_least_values():
    h = np.arange(50, dtype=np.uint64)
    for size in (1, 2, 3, 7, 13, 24):
        grams = windows.gram_hashes(h, size)
        assert len(grams) == 50 - size + 1 and len(set(grams.tolist())) == len(grams)
        again = windows.gram_hashes(np.concatenate([h, h]), size)
        assert (again[: len(grams)] == grams).all() and (again[50 : 50 + len(grams)] == grams).all()
    values = np.random.default_rng(1).integers(0, 99, 60).astype(np.uint64)
    for size in (1, 2, 5, 8, 13):
        expected = [values[i : i + size].min() for i in range(len(values) - size + 1)]
        assert windows.sliding_least(values, size).tolist() == expected


def test_equal_strings_of_a_task_travel_once():
    spec = Windows(13, 4, True, True)
    cutter = windows.Cutter(spec, np.empty(0, np.uint64))
    text = " ".join(f"w{i}" for i in range(60))
    pieces = [(i, 0, *p) for i in range(1000) for p in cutter.pieces(text)]
    strings, _, = cutter.strings(pieces)[:2]
    kept, runs = windows.merged(strings, spec)
    assert len(strings) == 1000 * len(kept) and len(runs[0]) == len(strings) - len(kept)


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_that_repeat_themselves(spark, monkeypatch, seed):
    monkeypatch.setattr(windows, "FLUSH_BYTES", 3000)
    monkeypatch.setattr(windows, "BUCKET_BYTES", 6000)
    r = np.random.default_rng(seed)
    passages = [" ".join(r.choice(list("abc"), 20)) for _ in range(4)]
    some = ["a " * 400, "b " * 3000, "a " * 700, "a b " * 300]
    some += [" ".join([passages[k] for k in r.integers(0, 4, 12)] + [f"w{i}"] * 15) for i in range(25)]
    some += [passages[0] + " c " + passages[0], "a " * 12]
    ids = [None if i % 9 == 4 else i for i in range(len(some))]
    check_words(documents(spark, [*some, some[1], some[3]], [*ids, 1, None]).repartition(3))


def test_a_documents_own_copies_travel_once():
    spec = Windows(13, 4, True, True)
    cutter = windows.Cutter(spec, np.empty(0, np.uint64))
    pieces = [(5, 0, *p) for p in cutter.pieces("a " * 50_000)] + [(5, 1, *p) for p in cutter.pieces("a " * 300)]
    strings = cutter.strings(pieces)[0]
    kept, runs = windows.merged(strings, spec)
    assert len(strings) > 50_000 and len(kept) == 2 and sorted(kept.tags.tolist()) == [0, 1]
    assert [list(r) for r in runs] == [[5, 5], [0, 1], [0, 0], [0, 0]]


def test_ten_million_equal_words_in_little_memory():
    spec, words = Windows(13, 4, True, True), 10_000_000
    cutter = windows.Cutter(spec, np.empty(0, np.uint64))
    blocks = ((*cutter.strings([(7, 0, *p)])[:2],) for p in cutter.pieces("a " * words))
    left = [len(kept) for kept, _, _ in windows._flushed(((s, g) for s, g in blocks), spec)]
    assert max(left) == 1 and len(left) >= 10
    data = np.array([[0, 0], [5, 13]], "<u4").tobytes()
    assert windows.covered_with_repeats([data], [b"a"] * 1_000_000, 13).all()


def test_classes_of_windows():
    r = np.random.default_rng(3)
    tokens = [bytes([x]) for x in r.integers(97, 99, 500)]
    for size in (1, 2, 3, 8, 13):
        classes = windows.window_classes(tokens, size)
        seen = [tuple(tokens[i : i + size]) for i in range(500 - size + 1)]
        assert len(classes) == len(seen) and len(set(classes.tolist())) == len(set(seen)) == len(set(zip(seen, classes.tolist(), strict=True)))


def test_anchors_are_counted_without_a_floor(monkeypatch):
    """An anchor with few strings in every flush adds up to about their number."""
    spec, sums = Windows(13, 4, True, True), 0
    flushes = []
    for k in range(400):
        ids = np.full(3, k)
        columns = [ids, np.zeros(3, int), np.arange(3), np.ones(3, int), np.zeros(3, int)]
        flushes.append((windows.Strings.of(columns, [f"{k} {i}".encode() for i in range(3)]), np.full(3, 12345, np.uint64), None))
    monkeypatch.setattr(windows, "_flushed", lambda *_: iter(flushes))
    for batch in windows._anchor_weights(spec)(iter(())):
        sums += sum(batch.column(1).to_pylist())
    assert abs(sums - 1200) < 5 * (windows.SENT * 1200) ** 0.5


def test_few_suffixes_are_sorted_at_once(monkeypatch):
    r, sizes = np.random.default_rng(3), []
    refined = suffixes.refined
    monkeypatch.setattr(suffixes, "refined", lambda tokens, *rest: sizes.append(len(tokens)) or refined(tokens, *rest))
    texts = [r.integers(0, 256, 120, np.uint8).tobytes() for _ in range(4_000)] * 2
    n = len(texts)
    same = np.arange(n)
    strings = windows.Strings.of([same, 0 * same, 0 * same, 0 * same + 21, 0 * same + 48], texts)
    runs = np.concatenate([np.stack(x) for x in windows._solved(strings, suffixes.SPEC, suffixes.by_refinement)], axis=1)
    assert sum(sizes) == 120 * n and max(sizes) <= 200_000
    assert sorted(map(tuple, runs.T.tolist())) == [(k, 0, 0, 120) for k in range(n // 2, n)]
