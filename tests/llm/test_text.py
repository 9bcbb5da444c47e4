"""Operators 4, 7, 8 and 9, and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests_llm_cases import documents, table

import corpus_pipeline
from perigee.llm import mixing, multiset, pii, quality, toxicity
from perigee.llm.labelled import held_out, sample
from perigee.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# ---- fingerprints


def test_edited_texts_and_equal_fingerprints(spark, settings):
    settings(shuffle__partitions=3)
    df, _ = table(spark)
    rows = df.select("doc_id", "text").collect()
    got = multiset.fingerprints(df).collect()
    assert len(got) == len(rows)
    known = sorted(((r.doc_id, r.text or "") for r in rows if r.doc_id is not None), reverse=True)
    single = [i for i, _ in known if sum(j == i for j, _ in known) == 1]
    by_id = {r.doc_id: r for r in got}
    for k, (i, text) in enumerate(known[:-1]):
        if i in single and i - 1 in single:
            half = len(text) // 2
            edited = text[: len(text) - half] + known[k + 1][1][:half]
            assert by_id[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and by_id[i].n_chars == len(text)
    texts = {}
    for r in rows:
        texts.setdefault(r.text or "", set()).update(g.fingerprint for g in got if g.doc_id == r.doc_id and r.doc_id is not None)
    assert all(len(f) <= 1 for f in texts.values())
    assert all(0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1 for g in got)


def test_paragraphs_add_up_in_any_order(spark):
    df = documents(spark, ["a b\nc d\n", "c d\na b\n", "a b", "c d", "", "a b\nc e\n"])
    rows = {r.doc_id: r.vector for r in multiset.sketched(df.select("doc_id", "text"), "text", ["doc_id"]).collect()}
    assert rows[0] == rows[1] != rows[5]
    for lanes, power in (("check", 31), ("sketch", 24)):
        parts = zip(rows[2][lanes], rows[3][lanes], rows[4][lanes], strict=True)
        assert [sum(p) % (1 << power) for p in parts] == list(rows[0][lanes])


def test_paragraphs_are_inserted_and_deleted(spark):
    df = documents(spark, ["a b\nc d\ne f g", "a b\ne f g", "c d"])
    rows = multiset.sketched(df.select("doc_id", "text"), "text", ["doc_id"]).select("doc_id", "vector")
    by = {k: rows.filter(f"doc_id = {k}").select(F.col("vector").alias(f"v{k}")) for k in range(3)}
    one = by[0].join(by[1]).join(by[2])
    same = one.select(
        multiset.added(F.col("v1"), F.col("v2")) == F.col("v0"), multiset.removed(F.col("v0"), F.col("v2")) == F.col("v1"),
        multiset.removed(F.col("v0"), F.col("v1")) == F.col("v2"), multiset.added(F.col("v0"), F.col("v2")) == F.col("v0"),
    ).first()
    assert tuple(same) == (True, True, True, False)


def test_likeness_is_near_the_cosine_of_word_pairs(spark):
    r = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(120):
        first = [r.choice(words) for _ in range(300)]
        cut = r.randint(0, 300)
        texts += [" ".join(first), " ".join([*first[:cut], *(r.choice(words) for _ in range(300 - cut))])]
    pairs = [Counter(zip(w, [*w[1:], ""], strict=True)) for w in (t.split() for t in texts)]
    vectors = multiset.sketched(documents(spark, texts).select("doc_id", "text"), "text", ["doc_id"])
    a = vectors.filter("doc_id % 2 = 0").select("doc_id", F.col("vector").alias("a"))
    b = vectors.filter("doc_id % 2 = 1").select((F.col("doc_id") - 1).alias("doc_id"), F.col("vector").alias("b"))
    errors = []
    for row in a.join(b, "doc_id").select("doc_id", multiset.likeness(F.col("a"), F.col("b")).alias("near")).collect():
        x, y = pairs[row.doc_id], pairs[row.doc_id + 1]
        exact = sum(n * y[p] for p, n in x.items()) / (sum(n * n for n in x.values()) * sum(n * n for n in y.values())) ** 0.5
        errors.append(abs(row.near - exact))
    assert len(errors) == 120 and np.mean(errors) < 0.1 and max(errors) < 0.5


@pytest.mark.parametrize("equal_texts", [False, True])
def test_rows_without_ids_spread_over_ranges(spark, settings, equal_texts):
    settings(shuffle__partitions=8)
    texts = ["same text" if equal_texts and k % 2 else f"text {k} " * 3 for k in range(400)]
    ids = [None if k % 2 else k for k in range(400)]
    docs = documents(spark, texts, ids)
    lowest = F.lit(multiset.LOWEST)
    rows = docs.select(F.coalesce("doc_id", lowest).alias("id"), F.xxhash64("text").alias("tie"), "text").withColumn("salt", F.rand(3))
    bounds = multiset._bounds(rows)
    held = rows.collect()
    sizes = Counter(sum(b <= (r.id, r.tie >> 12, r.salt) for b in bounds) for r in held)
    assert max(sizes.values()) <= 130
    following = {(r.id, r.tie, r.next.id, r.next.tie) for r in multiset.with_next(rows.drop("salt"), ["id", "tie"]).collect()}
    order = sorted(((r.id, r.tie) for r in held), reverse=True)
    assert following == {(*a, *b) for a, b in zip(order, [*order[1:], order[0]], strict=True)}
    got = multiset.fingerprints(docs).collect()
    assert len(got) == 400 and sorted(r.doc_id for r in got if r.doc_id is not None) == [i for i in ids if i is not None]
    by_text = {(r.id, r.tie): r.text for r in held}
    edited = lambda a, b: a[: len(a) - len(a) // 2] + b[: len(a) // 2]
    wanted = Counter(hashlib.sha256(edited(by_text[a], by_text[b]).encode()).hexdigest() for a, b in zip(order, [*order[1:], order[0]], strict=True))
    assert Counter(r.edited_sha256 for r in got) == wanted


def test_fingerprints_of_a_very_long_text(spark):
    text = "word pair\n" * 300_000
    rows = {r.doc_id: r for r in multiset.fingerprints(documents(spark, [text, "word pair", text])).collect()}
    assert rows[0].n_chars == len(text) and rows[0].fingerprint == rows[2].fingerprint != rows[1].fingerprint


def test_fingerprints_of_one_row_and_none(spark):
    one = multiset.fingerprints(documents(spark, ["abcd"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1
    assert multiset.fingerprints(documents(spark, [])).count() == 0


# ---- personal data

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base(text):
    found = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if (kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits))) or (kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            found.append((m.start(), k, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def odd_personal_texts():
    fixed = [
        "a@b.c.@d.e x@y.z_w@v.u", "1.2.3.4@x.com 4111111111111111@b.c +1234567890@q.r", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 999.1.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112",
        "+1 (234) 567-8901 +12 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "漢字 a@b.cd 𝄞 +49 30 1234567", "1" * 30_000, "a" * 30_000 + "@b.c",
        "1." * 20_000, "a.b" * 9_000, "x@" + "a." * 9_000 + "b", "4 " * 9_000, "", None,
    ]
    r = random.Random(4)
    return fixed + ["".join(r.choice("ab1234567890.@+- ()_%\n") for _ in range(r.randint(0, 120))) for _ in range(300)]


def test_base_spans_equal_the_plain_patterns(spark):
    some = odd_personal_texts()
    rows = pii.personal_data(documents(spark, some)).select("row.doc_id", "base", "spans").collect()
    assert len(rows) == len(some)
    for r in rows:
        expected = base(some[r.doc_id] or "")
        assert [(pii.KINDS[s.kind], s.start, s.end) for s in r.base] == expected
        assert {(s.start, s.end) for s in r.base} <= {(s.start, s.end) for s in r.spans}
        assert all(some[r.doc_id][s.start : s.end] == s.match for s in r.spans)


def test_trusted_contexts_find_what_no_base_pattern_knows(spark):
    some = [f"please write to the desk mail{i}@example.com today thanks" for i in range(12)]
    some += ["please write to the desk AB-1234-99 today thanks", "page 1234 of the plain book from 2024 here"]
    rows = {r.doc_id: r for r in pii.personal_data(documents(spark, some)).select("row.doc_id", "base", "spans").collect()}
    assert [s.match for s in rows[12].spans] == ["AB-1234-99"] and not rows[12].base
    assert not rows[13].spans
    clean = {r.doc_id: r for r in pii.redacted(documents(spark, some)).collect()}
    assert clean[0].text == "please write to the desk [email] today thanks" and clean[0].n_chars == len(clean[0].text)
    assert clean[12].text == "please write to the desk [id] today thanks" and clean[13].text == some[13]


def test_personal_data_of_odd_tables(spark):
    df, _ = table(spark)
    assert pii.redacted(df).columns == df.columns and pii.redacted(df).count() == df.count()
    assert pii.personal_data(documents(spark, [])).count() == 0


# ---- classifiers


def labelled_texts(number=600):
    r = random.Random(6)
    words = [f"{a}{b}" for a in ("lor", "ip", "dol", "sit", "am", "con") for b in ("em", "sum", "or", "et", "ix", "ur")]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    out = []
    for k in range(number):
        toxic = k % 4 == 0
        out.append((f"{text(30)} {r.choice(('vile', 'scummy', 'rotten')) if toxic else 'kind'} {text(30)}", int(toxic)))
    return out


def test_toxicity_on_held_out_rows_and_hidden_in_long_texts(spark):
    some = labelled_texts()
    docs = documents(spark, [t for t, _ in some] + [None, ""])
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(some)] + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(docs, labels).collect()
    held = [r for r in rows if r.held_out and r.doc_id < len(some)]
    assert len(rows) == len(some) + 2 and sum(r.predicted == some[r.doc_id][1] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}
    weights = toxicity.learned(docs, labels)
    harmless = " ".join(t for t, y in some if not y)
    assert toxicity.Scorer(weights).score(harmless) < 0.7 <= toxicity.Scorer(weights).score(harmless + " vile rotten")


def test_long_clean_texts_do_not_add_up_to_toxic_ones():
    r = random.Random(12)
    letters = "abcdefghijklmnoprstuvwz"
    rare = list(dict.fromkeys("".join(r.choice(letters) for _ in range(r.randint(3, 9))) for _ in range(60_000)))
    some = []
    for k in range(900):
        words = [r.choice(rare) for _ in range(r.choice((40, 150, 400)))]
        for at in range(0, len(words) if k % 8 == 0 else 0, 30):
            words[at] = r.choice(("vile", "scummy", "rotten"))
        some.append((" ".join(words), int(k % 8 == 0)))
    scorer = toxicity.Scorer(toxicity.fit([t for t, _ in some], [y for _, y in some]))
    assert len(rare) > 50_000 and len(toxicity.words_of(" ".join(rare[:20_000]))) == 20_000
    assert all(scorer.score(" ".join(rare[:n])) < 0.5 for n in (1_000, 20_000, 50_000))
    assert scorer.score(" ".join([*rare[:20_000], "vile and rotten and scummy", *rare[20_000:40_000]])) >= 0.7
    assert sum((scorer.score(t) >= 0.7) == y for t, y in some) >= 0.98 * len(some)


@pytest.mark.parametrize("stretch", [1, 4, 30])
def test_strongest_stretch_is_that_of_brute_force(stretch):
    r = random.Random(stretch)
    for _ in range(60):
        weight = {w: r.choice((0, 0, 0.5, 1.0, 2.5)) for w in "abcdefgh"}
        words = [r.choice("abcdefgh") for _ in range(r.randint(0, 50))]
        best = max((sum(weight[w] for w in set(words[i : i + stretch])) for i in range(len(words))), default=0)
        found, inside = toxicity.strongest([(i, w, weight[w]) for i, w in enumerate(words) if weight[w]], stretch)
        assert found == pytest.approx(best) and sum(weight[w] for w in inside) == pytest.approx(best)


def test_swapped_mentions_lower_the_score_of_neutral_ones():
    toxic = [f"those muslims are vile people {i}. and more" for i in range(60)] + [f"a vile thing {i}" for i in range(60)]
    neutral = [f"christians and men sang songs {i}." for i in range(60)] + [f"a kind thing {i}" for i in range(60)]
    texts, labels = toxic + neutral, [1] * len(toxic) + [0] * len(neutral)
    plain, fair = toxicity.fit(texts, labels, swap_weight=0), toxicity.fit(texts, labels)
    mention = "our muslims sang songs."
    assert toxicity.Scorer(fair).score(mention) < toxicity.Scorer(plain).score(mention)
    assert toxicity.Scorer(fair)["muslims"] < toxicity.Scorer(plain)["muslims"]
    before, after = toxicity.swapped("The Muslims came. Nobody else.")[0]
    assert "muslims" in before and "muslims" not in after and len(before) == len(after)


def test_quality_on_held_out_rows(spark):
    r = random.Random(9)
    good = labelled_texts()
    some = [(t, 1) for t, _ in good[:300]] + [(" ".join(w + r.choice(("%%%", "$$$")) for w in t.split()), 0) for t, _ in good[300:450]]
    some += [(t.split()[0] + (" " + t.split()[0]) * 50, 0) for t, _ in good[450:]]
    docs = documents(spark, [t for t, _ in some] + [None, ""])
    labels = spark.createDataFrame([(i, y, 0) for i, (_, y) in enumerate(some)], "doc_id long, quality int, toxic int")
    rows = quality.quality(docs, labels).collect()
    held = [r for r in rows if r.held_out and r.doc_id < len(some)]
    assert len(rows) == len(some) + 2 and sum(r.predicted == some[r.doc_id][1] for r in held) >= 0.95 * len(held)


def test_classifiers_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df, _ = table(spark)
    assert {r.predicted for r in toxicity.toxicity(df, none).collect()} == {0}
    assert {r.score for r in quality.quality(df, none).collect()} == {0.5}
    assert quality.quality(documents(spark, []), none).count() == toxicity.toxicity(documents(spark, []), none).count() == 0


def test_held_out_rows_by_checksum(spark):
    rows = spark.range(200).select("id", held_out(multiset.F.col("id"), 3, 1).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def redacted_by_hand(text, spans):
    names, at, out = (*pii.KINDS, pii.FOUND), 0, []
    for start, end, kind in sorted(spans, key=lambda s: (s[0], s[2], s[1])):
        if start >= at:
            out += [text[at:start], f"[{names[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_redaction_of_spans_that_overlap_and_cross_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(pii, "BLOCK", block)
    r = random.Random(block)
    texts, spans = [], []
    for k in range(60):
        text = "".join(r.choice("ab \n漢😀") for _ in range(r.randint(1, 60)))
        own = {(s, min(len(text), s + r.randint(1, 20)), r.randint(0, 4)) for s in (r.randrange(len(text)) for _ in range(r.randint(1, 6)))}
        texts.append((f"k{k}", text))
        spans += [(f"k{k}", *span, "m") for span in own]
    some = spark.createDataFrame([*texts, ("none", "left alone")], "key string, text string")
    found = spark.createDataFrame(spans, "key string, start int, end int, kind int, match string")
    got = {row.key: row.clean for row in pii._redacted_texts(some, found).collect()}
    assert got == {key: redacted_by_hand(text, [s[1:4] for s in spans if s[0] == key]) for key, text in texts}


def test_seeds_are_words_that_share_a_place_with_a_span(spark):
    r = random.Random(4)
    words = [(f"k{r.randint(0, 3)}", f"w{k}", s, s + r.randint(1, 6)) for k, s in enumerate(r.randrange(200) for _ in range(150))]
    base = [(f"k{r.randint(0, 3)}", s, s + r.randint(1, 9), 0, "m") for s in (r.randrange(200) for _ in range(25))]
    df = spark.createDataFrame(words, "key string, word string, start int, end int")
    spans = spark.createDataFrame(base, "key string, start int, end int, kind int, match string")
    got = {row.word: row.seed for row in pii._seeds(df, spans).collect()}
    assert got == {w[1]: any(b[0] == w[0] and b[1] < w[3] and b[2] > w[2] for b in base) for w in words}


def trusted_by_hand(edges):
    """Patterns trusted after turns of scoring over (pattern, word, seed) triples, in plain Python."""
    seed = {}
    for pattern, word, is_seed in edges:
        seed[pattern, word] = max(seed.get((pattern, word), 0.0), float(is_seed))
    words_of_pattern = {p: {w for q, w in seed if q == p} for p, _ in seed}
    kept = {p: ws for p, ws in words_of_pattern.items() if len(ws) >= pii.LEAST_INSTANCES}
    own = {}
    for (p, w), v in seed.items():
        if p in kept:
            own[w] = max(own.get(w, 0.0), v)
    score = dict(own)
    for turn in range(pii.TURNS):
        trust = {p: sum(score[w] for w in ws) / len(ws) for p, ws in kept.items()}
        if turn < pii.TURNS - 1:
            score = {w: max(own[w], 0.5 * max(trust[p] for p, ws in kept.items() if w in ws)) for w in own}
    return {p for p, t in trust.items() if t >= pii.TRUSTED}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trusted_patterns_are_those_of_brute_force(spark, seed):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(25)]
    is_seed = {w: r.random() < 0.4 for w in words}
    edges = [(f"p{r.randint(0, 30)}", w, is_seed[w] or r.random() < 0.05) for w in (r.choice(words) for _ in range(160))]
    df = spark.createDataFrame([(k, w, k, k + 1, s, p) for k, (p, w, s) in enumerate(edges)], "key int, word string, start int, end int, seed boolean, pattern string")
    got = {row.pattern for row in pii._trusted_patterns(df).collect()}
    assert got == trusted_by_hand(edges) and 0 < len(got) < 31


def test_many_matches_in_one_text_take_time_in_proportion(spark):
    import time

    taken = {}
    for n in (10_000, 100_000):
        text = " ".join(f"mail a{k}@b{k % 97}.org now" for k in range(n))
        began = time.perf_counter()
        row = pii.redacted(documents(spark, [text])).select("text").first()
        taken[n] = time.perf_counter() - began
        assert row.text.count("[email]") == n and "@" not in row.text
    assert taken[100_000] < 20 * taken[10_000]


def test_texts_of_any_length_are_learned_from(spark):
    r = random.Random(3)
    filler = " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(150_000))  # over 1 MB
    texts = [f"{filler[: r.randint(0, 200)]} plain talk {k}" for k in range(60)]
    texts += [f"{filler} wretched {filler[: k * 7]}" if k < 4 else f"wretched scum {k}" for k in range(30)]
    y = [0] * 60 + [1] * 30
    labels = spark.createDataFrame([(i, int(not v), v) for i, v in enumerate(y)], "doc_id long, quality int, toxic int")
    docs = documents(spark, texts)
    kept = sample(docs, labels, "toxic", 3, 1, 1_000).select("id", "text").collect()
    assert max(len(k.text) for k in kept) > 1_000_000 and all(k.text == texts[k.id] for k in kept)
    by_hand = sorted((k.id, y[k.id]) for k in kept)
    whole = toxicity.fit([texts[i] for i, _ in by_hand], [v for _, v in by_hand])
    assert toxicity.learned(docs, labels) == pytest.approx(whole)
    assert sample(docs, labels, "toxic", 3, 1, 7).count() == 7
    assert toxicity.toxicity(docs, labels, fit_rows=50).count() == len(texts)


def test_long_words_have_their_character_groups(spark):
    word = ("abcdefghijklmnopqrstuvwxyz" * 9)[:200].encode()
    features = [at for piece in quality.pieces_of(word) for at in piece]
    assert features == quality.features_of(word)
    assert len(features) == 1 + (202 - 2) + (202 - 3)
    adds = np.zeros(quality.BUCKETS, np.float32)
    adds[features[5]] = 1.0
    assert quality.Scorer(adds, 0.0)[word][0] > 0 and quality.Scorer(adds, 0.0)[b"zzz"][0] == 0
    long = "x" * 3_000_000
    assert quality.Scorer(adds, 0.0)[long.encode()][1] == 1 + 3_000_000 + 2_999_999
    docs = documents(spark, [long, "short", None] * 8)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(24)], "doc_id long, quality int, toxic int")
    rows = quality.quality(docs, labels, fit_rows=10).collect()
    assert len(rows) == 24 and len({r.score for r in rows if r.doc_id % 3 == 0}) == 1


# ---- pipeline and registration


def test_pipeline_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns and 0 < docs.count() <= 3 * before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def simhash_by_hand(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    width = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(len(words) - width + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_pipeline_rows_are_those_of_plain_stages(spark):
    """run() against the five stages in plain Python, which take the learned weights, the spans and the copies as given."""
    import public_tokenizers
    from tokenizers import Tokenizer

    table_ = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [r.asDict() for r in table_.collect()]
    scorer = toxicity.Scorer(toxicity.learned(table_, spark.read.parquet(f"{SF}/labels.parquet")))
    docs = [d for d in docs if scorer.score(d["text"]) < 0.7]
    prints = {d["doc_id"]: simhash_by_hand(d["text"]) for d in docs}
    left, kept = set(prints), set()
    while left:
        head = min(left)
        group, front = {head}, [head]
        while front:
            at = front.pop()
            near = {i for i in left - group if (prints[i] ^ prints[at]).bit_count() <= 4}
            group |= near
            front += near
        kept.add(head)
        left -= group
    docs = [d for d in docs if d["doc_id"] in kept]
    frame = spark.createDataFrame([tuple(d.values()) for d in docs], table_.schema)
    spans = {r.doc_id: r.spans for r in pii.personal_data(frame, ["doc_id"]).select("row.doc_id", "spans").collect()}
    names = (*pii.KINDS, pii.FOUND)
    for d in docs:
        own = [(s.start, s.end, s.kind) for s in spans[d["doc_id"]]]
        found = {(names[k], a, b) for a, b, k in own if k < len(pii.KINDS)}
        assert found == set(base(d["text"] or ""))
        if own:
            d["text"] = redacted_by_hand(d["text"], own)
            d["n_chars"] = len(d["text"])
    frame = spark.createDataFrame([tuple(d.values()) for d in docs], table_.schema)
    copies = {r.doc_id: r.copies for r in mixing.mix(frame).collect()}
    coder = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    wanted = Counter()
    for d in docs:
        ids = [*coder.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            wanted[d["doc_id"], piece, start, len(part), crc] += copies[d["doc_id"]]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == +wanted
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048


def test_pipeline_of_repeated_ids_and_of_no_documents(spark, tmp_path):
    a, b = "alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine"
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, rows in (("odd", [(2, a), (5, a), (5, b), (7, b), (None, a), (9, None), (11, "")]), ("none", [])):
        docs = [(i, t, "en", "web", None if t is None else len(t)) for i, t in rows]
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
    held = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()}
    assert held == {2, 5, None, 9}
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("number", range(1, 11))
def test_each_operator_has_a_query(number):
    assert sum(name.startswith(f"op{number}_") for name in QUERIES) == 1
