"""Merkle manifest, hard negatives and license scan against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_cases import documents, table, texts

from perigee.llm import licenses, merkle, negatives
from perigee.llm.queries import QUERIES

# ---- Merkle manifest


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row) -> str:
    def item(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return digest(*(item(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def tree_by_hand(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root and the path of each leaf."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        nodes = levels[-1]
        levels.append([digest(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)])
    paths = []
    for place in range(len(leaves)):
        path = []
        for nodes in levels[:-1]:
            begin = place // 8 * 8
            path.append(("".join(nodes[begin:place]), "".join(nodes[place + 1 : begin + 8])))
            place //= 8
        paths.append(path)
    return levels[-1][0], paths


def manifest_by_hand(rows) -> list[tuple]:
    parts: dict = {}
    for r in rows:
        parts.setdefault(r["lang"], []).append(r)
    order = sorted(parts, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in order:
        key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_by_hand(r))
        some = sorted(parts[lang], key=key)
        trees[lang] = some, *tree_by_hand([leaf_by_hand(r) for r in some])
    root, upper = tree_by_hand([trees[lang][1] for lang in order]) if order else (None, [])
    out = []
    for lang, above in zip(order, upper, strict=True):
        some, subroot, paths = trees[lang]
        for r, path in zip(some, paths, strict=True):
            whole = path + above
            lower = None if r["text"] is None else re.sub("[A-Z]", lambda m: m[0].lower(), r["text"])
            changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            h = leaf_by_hand({**r.asDict(), "text": lower} if changed else r)
            for a, b in whole:
                h = digest(a, h, b)
            proof = digest(*(a + b for a, b in whole))
            out.append((r["doc_id"], leaf_by_hand(r), subroot, root, proof, h, h == root))
    return sorted(out, key=repr)


def manifest_of(docs):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.tampered(docs, changed)
    some = rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_of(F.col("path")), "folded_root", "verified").collect()
    return sorted((tuple(r) for r in some), key=repr)


def langs():
    by = F.col("doc_id")
    return F.when(by % 11 == 0, None).when(by % 7 == 0, "Ünì").when(by == 9, "").otherwise("en")


@pytest.mark.parametrize("block, rows", [(8, 16), (4096, 1 << 20)])
def test_manifest_is_that_of_brute_force(spark, monkeypatch, block, rows):
    monkeypatch.setattr(merkle, "BLOCK", block)
    monkeypatch.setattr(merkle, "RANGE_ROWS", rows)
    some = [*texts(3, 150), "AbC Ü", "x" * 200_000]
    ids = [*range(len(some))]
    docs = documents(spark, [*some, some[5], some[30], some[30], None, "A"], [*ids, 5, 30, 31, None, None]).withColumn("lang", langs())
    for name in ("part", "pos", "digest", "path", "left", "root", "carried"):
        docs = docs.withColumn(name, F.lit(name))
    held = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    assert manifest_of(docs) == manifest_by_hand(held)


@pytest.mark.parametrize("number", [0, 1, 2, 8, 9, 64, 65])
def test_manifest_of_few_rows(spark, number):
    docs = documents(spark, [f"Text {k}" for k in range(number)])
    assert manifest_of(docs) == manifest_by_hand(docs.collect())


def test_manifest_of_rows_that_are_all_equal(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 10)
    docs = documents(spark, ["Same"] * 90, [None] * 90)
    got = manifest_of(docs)
    assert got == manifest_by_hand(docs.collect()) and len(got) == 90 and len({r[3] for r in got}) == 1


def test_equal_rows_are_dealt_to_several_ranges(spark, monkeypatch, settings):
    settings(shuffle__partitions=4)
    rows = spark.range(400).select(F.lit("1en").alias("part"), F.lit(7).alias("doc_id"), F.col("id").alias("salt"))
    seen = []
    monkeypatch.setattr(merkle, "saved", lambda df, label: seen.append(df) or df)
    merkle.placed(rows, ["doc_id"])
    assert max(r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()) <= 200


def test_a_sibling_that_changes_breaks_the_proof(spark):
    docs = documents(spark, [f"text {k}" for k in range(20)])
    row = merkle.manifest(docs).filter("doc_id = 3")
    leaf, root = F.col("leaf"), F.col("root")
    other = F.transform("path", lambda s: F.struct(F.reverse(s["left"]).alias("left"), s["right"].alias("right")))
    checks = row.select(merkle.folded(leaf, F.col("path")) == root, merkle.folded(leaf, other) == root).first()
    assert tuple(checks) == (True, False)


# ---- hard negatives


def mined_by_hand(rows, positives=5, negatives_=10, least=30, most=90, anchor=lambda i: i % 10 == 0):
    sound = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        sound.append((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for a in sorted({r for r in sound if anchor(r[0])}):
        scored = [(-sum(x * y for x, y in zip(a[2], r[2], strict=True)), r[0], r[1]) for r in sound if r[0] != a[0] and len(r[2]) == len(a[2])]
        for p in sorted(s for s in scored if s[2] == a[1])[:positives]:
            near = sorted(s for s in scored if s[2] != a[1] and least * -p[0] <= 100 * -s[0] <= most * -p[0])[:negatives_]
            out += [(a[0], p[1], k + 1, n[1], -p[0], -n[0]) for k, n in enumerate(near)]
    return sorted(out)


def vectors(spark, rows):
    kinds = "vec_id long, label int, embedding array<float>, score string, slot string, anchor string, rank string, size string"
    return spark.createDataFrame([(*r, "s", "t", "u", "v", "w") for r in rows], kinds)


def random_rows(seed, number, size=11):
    r = random.Random(seed)
    single = lambda x: float(np.float32(x))
    rows = [(k, r.randint(0, 3), [single(r.choice((r.uniform(-1, 1), 0.25, -0.5))) for _ in range(size)]) for k in range(number)]
    rows += [(None, 1, [0.5] * size), (7, None, [0.5] * size), (20, 1, None), (30, 1, [0.5, None]), (40, 1, [float("nan")] * size)]
    rows += [(50, 2, [float("inf")] * size), (60, 1, [0.0] * size), (70, 1, [0.1, 0.2]), (71, 1, [0.3, 0.2]), (72, 2, [0.1, 0.1]), (80, 0, [])]
    return rows + [rows[3], rows[10], rows[10], (10, 3, rows[11][2])]


@pytest.mark.parametrize("seed, small", [(1, True), (2, False)])
def test_negatives_are_those_of_brute_force(spark, monkeypatch, seed, small):
    if small:
        for name, value in {"BLOCK": 6, "TABLES": 2, "CHUNK": 5}.items():
            monkeypatch.setattr(negatives, name, value)
        monkeypatch.setattr(negatives.Best, "FOLD", 7)
    rows = random_rows(seed, 130)
    found = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in found.collect()) == mined_by_hand(rows)


def test_negatives_with_ties_and_few_partners(spark):
    rows = [(k, k % 2, [0.5, 0.5]) for k in range(12)] + [(100, 0, [0.25, 0.5]), (101, 5, [0.4, 0.3]), (110, 6, [1.0, 1.0])]
    found = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, positives=2, negatives=3)
    assert sorted(tuple(r) for r in found.collect()) == mined_by_hand(rows, 2, 3)


@pytest.mark.parametrize("rows", [[], [(1, 0, [0.5]), (2, 0, [0.5])], [(10, 0, [0.5])], [(10, None, None)]])
def test_negatives_of_nothing(spark, rows):
    found = negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert found.count() == 0 and found.columns[0] == "anchor_id"


@pytest.mark.parametrize("scale", [1, 900, 100_000])
def test_scores_are_exact_inner_products(scale):
    r = np.random.default_rng(scale)
    for size in (0, 1, 7, 8, 9, 64):
        a, b = r.integers(-scale, scale + 1, (2, 30, size))
        bits = int(scale).bit_length() + 1
        sums = negatives.subset_sums(a, np.int64)
        assert (negatives.scores(negatives.packed(b, bits), sums) == b @ a.T).all()


def test_components_too_large_are_refused(spark):
    with pytest.raises(ValueError, match="62 bits"):
        negatives.hard_negatives(vectors(spark, [(1, 1, [1e30])]), F.lit(True))


def test_blocks_hold_every_anchor_once(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 7)
    anchors = spark.range(100).select((F.col("id") * 16).alias("anchor"))
    blocks = [b.collect() for b in negatives._blocks(anchors)]
    assert sorted(r["anchor"] for b in blocks for r in b) == [k * 16 for k in range(100)]
    assert max(map(len, blocks)) <= 7


# ---- license scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_by_hand(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def scanned_by_hand(text, templates, contained):
    words = words_by_hand(text)
    places = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    share, labels = 0.0, {label for _, label in places}
    for begin in range(0, len(words), licenses.STEP):
        held = set(words[begin : begin + 2 * licenses.STEP])
        for label, template in templates:
            own = set(words_by_hand(template))
            if len(held & own) / len(own) >= contained:
                labels.add(label)
                share = max(share, len(held & own) / len(own))
    starts = [i for i, _ in places]
    base = ",".join(sorted({label for _, label in places}))
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None), base, ",".join(sorted(labels)), 1.0 if places else share
    )


def license_texts(seed=5, number=120):
    r = random.Random(seed)
    pool = [t for _, t in licenses.TEMPLATES]
    every = sorted({w for t in pool for w in t.split()})
    out = [*texts(), "CC-BY cc\nby, cc;by", "All RIGHTS reserved" * 3, "ACC BY", "cc by by cc by", "GENERAL Public licenſe", "KCC BY", "cc\x85by"]
    while len(out) < number:
        words = []
        for _ in range(r.randint(1, 4)):
            words += [r.choice("lorem ipsum dolor the of".split()) for _ in range(r.randint(0, 60))]
            some = r.choice(pool).split()
            for _ in range(r.randint(0, 3)):
                some[r.randrange(len(some))] = r.choice(every)
            words += some if r.random() < 0.8 else r.sample(some, len(some))
        out.append(r.choice((" ", ", ", "\n")).join(w.upper() if r.random() < 0.1 else w for w in words))
    return [*out, " ".join(out[-30:]) * 40]


@pytest.mark.parametrize("contained", [0.5, 0.75, 0.9, 1.0])
def test_scan_is_that_of_brute_force(spark, contained):
    some = license_texts()
    docs = documents(spark, [*some, some[50], some[60]], [*range(len(some)), 50, None])
    for name in ("words", "marks", "places", "block", "label"):
        docs = docs.withColumn(name, F.lit(1))
    got = licenses.summary(docs, contained=contained).collect()
    want = [(i, *scanned_by_hand(t, licenses.TEMPLATES, contained)) for i, t in zip([*range(len(some)), 50, None], [*some, some[50], some[60]], strict=True)]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(bool(w[6]) for w in want) > 30


def test_every_stretch_of_a_template_is_in_some_block(spark):
    _, template = licenses.TEMPLATES[2]
    some = ["lorem " * k + template + " ipsum" * 90 for k in range(0, 90, 7)]
    assert {r.labels for r in licenses.summary(documents(spark, some)).collect()} == {"mit"}


def test_scan_of_own_templates_and_phrases(spark):
    docs = documents(spark, ["you may copy this poem freely", "poem freely", "copy that", None])
    got = licenses.summary(docs, templates=[("poem", "copy this poem freely")], phrases={"may copy": "may"}, contained=0.75)
    assert sorted((r.doc_id, r.labels, r.score) for r in got.collect()) == [(0, "may,poem", 1.0), (1, "", 0.0), (2, "", 0.0), (3, "", 0.0)]
    with pytest.raises(ValueError):
        licenses.scan(docs, templates=[("long", "word " * 41)])


def test_scan_of_no_rows(spark):
    assert licenses.summary(documents(spark, [])).count() == 0


def test_scan_has_no_python_in_its_plan(spark):
    df, _ = table(spark)
    plan = licenses.summary(df)._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop") if p in plan]


@pytest.mark.parametrize("number", [11, 12, 13])
def test_each_new_operator_has_a_query(number):
    assert sum(name.startswith(f"op{number}_") for name in QUERIES) == 1
