"""Operators 2 and 6 against plain Python."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tests_llm_cases import documents, table, texts
from tokenizers import Tokenizer

from perigee.llm import mixing, packing
from perigee.llm.tokens import WordEncoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def expected_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in stopped]
        if not rest:
            return stopped
        left = total - sum(stopped.values())
        target = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if target[s] >= 3 * sizes[s]]
        if not over:
            return stopped | target
        stopped |= {s: 3.0 * sizes[s] for s in over}


def mixed_rows(spark):
    some = [" ".join(["w"] * (3 + k % 17)) for k in range(600)] + [None, "", " "]
    sources = ["b" if k % 3 else ("a", "c", "Z", "é", "漢", None)[k % 6] for k in range(len(some))]
    return documents(spark, some, sources=sources)


def test_targets_and_taken_words(spark):
    df = mixed_rows(spark)
    rows = mixing.mix(df).collect()
    text = {r.doc_id: r.text for r in df.collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.size == len((text[r.doc_id] or "").split())
        assert r.taken == r.copies * r.size <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    target = expected_targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(3, 0.02 * target[s])
    again = {(r.doc_id, r.taken) for r in mixing.mix(df.repartition(5)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mixed_repeats_rows_with_all_columns(spark):
    df = mixed_rows(spark)
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({i: n for i, n in copies.items() if n})


def test_mix_of_odd_rows_and_of_none(spark):
    df, _ = table(spark)
    assert mixing.mix(df).count() == df.count()
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [None, ""])).agg({"taken": "sum"}).first()[0] == 0


@pytest.mark.parametrize("number", [0, 1, 7, 300, 20_000])
def test_plan_places_every_length_and_wastes_little(number):
    lengths = np.clip(np.random.default_rng(number).lognormal(6, 1.2, number).astype(int), 1, 2048)
    counts = dict(Counter(lengths.tolist()))
    held, sequences = Counter(), 0
    for times, contents in packing.plan(counts):
        assert times > 0 and sum(n * k for n, k in contents) <= 2048
        for n, k in contents:
            held[n] += times * k
        sequences += times
    assert held == Counter(counts)
    assert sequences <= 1.03 * -(-int(lengths.sum()) // 2048) + 3


def test_plan_of_hot_lengths():
    counts = {1024: 1_000_000, 1025: 999, 700: 3_000_000, 3: 10}
    kinds = packing.plan(counts)
    assert sum(t for t, _ in kinds) <= 500_000 + 999 + 1_500_000 and len(kinds) < 50


def test_words_encode_like_whole_texts():
    tokenizer, encoder = Tokenizer.from_file(VOCABULARY), WordEncoder(VOCABULARY)
    some = [*texts(3), "Don't stop. U.S.A., e.g. 3.14, A.B! ... .,", "x<|endoftext|>y <|ENDOFTEXT|>", "İstanbul ΣΑΣ é é b c\x1cd"]
    for batch in (some, some[::-1]):
        for text, ids in zip(batch, encoder.encoded(batch), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_packed_pieces_are_whole_and_gapless(spark):
    df, _ = table(spark)
    rows = packing.packed(df.repartition(3), VOCABULARY).collect()
    tokenizer, expected = Tokenizer.from_file(VOCABULARY), Counter()
    for r in df.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at : at + 2048]
            expected[r.doc_id, k, at, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.packed(documents(spark, []), VOCABULARY).count() == 0


def test_empty_texts_are_copied_no_more_than_others(spark):
    texts = ["one two three"] * 4 + [None, "", " "] * 10 + ["word " * 400] * 20 + [""] * 5
    sources = ["a"] * 34 + ["b"] * 20 + ["c"] * 5
    rows = mixing.mix(documents(spark, texts, sources=sources)).collect()
    assert max(r.copies for r in rows) == 3 and {r.copies for r in rows if r.source == "a"} == {3}
    assert {(r.copies, r.taken) for r in rows if r.source == "c"} == {(1, 0)}


def test_sources_get_their_weights_in_order_of_code_points(spark):
    names = ["z", "Z", "é", "", "a", "10", "9", None, "漢", "aa"]
    rows = spark.createDataFrame([(n, 1000) for n in names], "source string, size long")
    ordered = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    total = sum((5, 2, 1)[k % 3] for k in range(len(ordered)))
    wanted = {n: (5, 2, 1)[k % 3] * 10_000 / total for k, n in enumerate(ordered)}
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(wanted)


def test_words_of_letters_and_marks_are_not_encoded_one_by_one():
    tokenizer, encoder = Tokenizer.from_file(VOCABULARY), WordEncoder(VOCABULARY)
    text = "Ciudad ciudad, órgano Órgano... levè&&& ouïe; straße! ΣΑΣ İstanbul'da it's, 'tis *** end*** <|endoftext|> a<|endoftext|> x_1_y 日本語。"
    alone = []
    each = encoder._encode_each
    encoder._encode_each = lambda words: alone.extend(words) or each(words)
    got = encoder.encoded([text, text.encode(), None])
    wanted = np.array(tokenizer.encode(" ".join(text.split()[:6]), add_special_tokens=False).ids, "<u4").tobytes()
    assert got[0] == got[1] and got[2] == b"" and got[0].startswith(wanted)
    for word in text.split():
        ids = np.array(tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encoded([word]) == [ids], word
    first = WordEncoder(VOCABULARY)
    first._encode_each = lambda words: alone.extend(words) or each(words)
    alone.clear()
    first.encoded([" ".join(text.split()[:7])])
    assert {*alone} == {b"&&&", b",", b"...", b";", b"!"}
