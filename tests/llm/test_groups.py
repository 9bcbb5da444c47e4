"""Operators 3 and 10 against brute force, and components."""

from __future__ import annotations

import hashlib
import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_cases import documents, table

from perigee.llm import simhash, vectors
from perigee.llm.components import connected_components
from perigee.llm.simhash import fingerprint_of


def components(n, linked):
    label = list(range(n))
    for a, b in linked:
        x, y = label[a], label[b]
        if x != y:
            label = [min(x, y) if v in (x, y) else v for v in label]
    return label


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(50)] + [(300, 301), (301, 302), (302, 300)]
    edges += [(7, 7), (301, 300), (None, 4), (5, None)]
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 100 for i in range(100, 161)} | {7: 7} | {200 + i: 7 for i in range(50)} | {300: 300, 301: 300, 302: 300}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected_groups(rows):
    prints = [fingerprint_of(t) for _, t in rows]
    known = [(i, p) for (i, _), p in zip(rows, prints, strict=True) if i is not None]
    distinct = sorted({p for _, p in known})
    linked = [(a, b) for a in range(len(distinct)) for b in range(a) if (distinct[a] ^ distinct[b]).bit_count() <= 4]
    label = dict(zip(distinct, components(len(distinct), linked), strict=True))
    least = {}
    for i, p in known:
        least[label[p]] = min(least.get(label[p], i), i)
    return [(i, f"{p:016x}", least.get(label.get(p))) for (i, _), p in zip(rows, prints, strict=True)]


def test_simhash_groups_equal_brute_force(spark):
    df, _ = table(spark)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=repr) == sorted(expected_groups(rows), key=repr)


def test_simhash_shingles_are_sparks_hashes(spark):
    h = spark.sql("SELECT xxhash64('a b c d') AS h").first().h & (2**64 - 1)
    assert fingerprint_of("A  b\tc D") == h
    assert fingerprint_of("a b") == spark.sql("SELECT xxhash64('a b') AS h").first().h & (2**64 - 1)
    assert fingerprint_of(None) == fingerprint_of(" \n") == 0


@pytest.mark.parametrize(("tile", "short"), [(4096, 48), (64, 4)])
def test_links_join_what_brute_force_joins(spark, monkeypatch, tile, short):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    random = np.random.default_rng(3)
    centres = random.integers(0, 1 << 63, 12)
    prints = {0, 1, 3, (1 << 63) - 1}
    for c in centres.tolist():
        for _ in range(30):
            prints.add(c ^ sum(1 << int(b) for b in random.choice(63, random.integers(0, 6), replace=False)))
    prints = sorted(prints)
    df = spark.createDataFrame([(p, i) for i, p in enumerate(prints)], "fp long, rep long")
    found = [tuple(r) for r in simhash.links(df).collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= 4 for a, b in found)
    true = [(a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert components(len(prints), found) == components(len(prints), true)


def test_one_of_each_keeps_columns_and_smallest_ids(spark):
    df = documents(spark, ["a b c d e", "A b c d e", "f g h i", "f g h i", None], [4, 2, 9, 9, None])
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [2, 9, None]


def brute_vectors(rows):
    usable = []
    for k, (i, v, label) in enumerate(rows):
        ok = i is not None and label is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)
        if ok:
            usable.append((k, np.array(v, float) / np.linalg.norm(np.array(v, float)), label))
    linked = [
        (a[0], b[0]) for x, a in enumerate(usable) for b in usable[:x] if a[2] == b[2] and len(a[1]) == len(b[1]) and a[1] @ b[1] >= 0.93
    ]
    label = components(len(rows), linked)
    least, links = {}, [0] * len(rows)
    for a, b in linked:
        links[a] += 1
        links[b] += 1
    for (i, _, _), c in zip(rows, label, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return [(r[0], n, least.get(c), r[0] is not None and r[0] == least.get(c)) for r, n, c in zip(rows, links, label, strict=True)]


def vector_rows(number=300):
    random = np.random.default_rng(8)
    centres = random.normal(size=(12, 16))
    rows = []
    for i in range(number):
        v = centres[i % 12] + random.normal(size=16) * (0.05 if i % 3 else 0.6)
        rows.append((i, [float(np.float32(x)) for x in v], i % 2))
    rows[40:60] = [(i, rows[40][1], 0) for i in range(40, 60)]
    odd = [None, [], [0.0] * 16, [None] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15]
    rows += [(number + k, v, 0) for k, v in enumerate(odd)]
    return rows + [(900, rows[0][1], None), (None, rows[0][1], 0), (901, [1.0, 2.0], 0), (902, [2.0, 4.0], 0)]


@pytest.mark.parametrize("shard", [1000, 40])
def test_vectors_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(vectors, "SHARD", shard)
    monkeypatch.setattr(vectors, "SHARD_MOST", 3 * shard)
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumnRenamed("vec_id", "vec_id")
    got = sorted((tuple(r) for r in vectors.near_duplicates(df).collect()), key=repr)
    expected = sorted(brute_vectors(rows), key=repr)
    true, found = sum(r[1] for r in expected), sum(r[1] for r in got)
    assert true > 1000 and found >= 0.98 * true and all(g[1] <= e[1] for g, e in zip(got, expected, strict=True))
    assert [(g[0], g[2], g[3]) for g in got] == [(e[0], e[2], e[3]) for e in expected]


def dense_beside_pairs():
    """600 near copies, 100 separate pairs and 200 others: one shard."""
    random = np.random.default_rng(11)
    rows = [random.normal(size=64) * 0.05 + 1 for _ in range(600)]
    for v in random.normal(size=(100, 64)):
        rows += [v, v + random.normal(size=64) * 0.1]
    rows += list(random.normal(size=(200, 64)))
    return [(i, [float(np.float32(x)) for x in rows[i]], 0) for i in random.permutation(len(rows)).tolist()]


def test_pairs_beside_a_dense_group_are_found(spark):
    rows = dense_beside_pairs()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in vectors.near_duplicates(df).collect()}
    pairs = range(600, 800)
    assert [got[i].n_links for i in pairs] == [1] * 200
    assert [got[i].component_id for i in pairs] == [i - i % 2 for i in pairs]
    assert sum(got[i].n_links for i in range(600)) >= 0.98 * 600 * 599 and {got[i].component_id for i in range(600)} == {0}
    assert all(got[i].n_links == 0 and got[i].kept for i in range(800, 1000))


def test_links_that_the_search_misses_are_found_by_all_pairs(spark, monkeypatch):
    """A search that finds dense groups only, as an audit of all links together would not notice."""
    searched = vectors._searched

    def blind(*args):
        inside = searched(*args)
        return inside & (inside.sum(axis=1) > 10)[:, None]

    monkeypatch.setattr(vectors, "_searched", blind)
    rows = dense_beside_pairs()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = [tuple(r) for r in vectors.near_duplicates(df).collect()]
    assert sorted(got) == sorted(brute_vectors(rows))


def test_audit_of_dense_tables_sees_small_groups(spark):
    rows = dense_beside_pairs()
    nodes = vectors.classes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    truth = vectors._audited(nodes)
    true = {r[0]: r[1] for r in brute_vectors(rows)}
    found = {r.a: r.n for r in truth.collect()}
    assert all(true[a] == n for a, n in found.items()) and sum(n == 1 for n in found.values()) >= vectors.ENOUGH
    lost = truth.select("a", F.when(F.col("n") > 1, F.col("n")).alias("links"))
    assert vectors._recall(truth, lost) == 0 and vectors._recall(truth, truth.withColumnRenamed("n", "links")) == 1


def test_search_from_outside_leaves_a_dense_group():
    v = np.array([r[1] for r in sorted(dense_beside_pairs())])[:620]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    table = vectors.pa.table({"rep": np.arange(620), "vector": list(v)})
    lists = vectors._graph(table)["near"].to_pylist()
    assert sum(any(j >= 600 for j in near) for near in lists[:600]) > 60
    assert len(set(vectors._spread(v).tolist())) == vectors.ENTRIES and sum(vectors._spread(v) >= 600) >= 10


def test_no_vectors(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0], [2, 1, 3, 0]])
def test_one_of_each_loses_no_text_of_an_id_that_repeats(spark, order):
    a, b = "alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine"
    some = [(2, a), (5, a), (5, b), (7, b)]
    docs = documents(spark, [some[k][1] for k in order], [some[k][0] for k in order])
    assert sorted((r.doc_id, r.text) for r in simhash.one_of_each(docs.coalesce(1)).collect()) == [(2, a), (5, b)]


def test_one_of_each_of_texts_that_share_an_id_and_a_fingerprint(spark):
    a, upper = "alpha beta gamma delta epsilon zeta", "ALPHA beta gamma delta epsilon zeta"
    for order in ([a, upper, a], [upper, a, a]):
        kept = simhash.one_of_each(documents(spark, [*order, None, ""], [4, 4, 4, 9, 8])).collect()
        assert [r.doc_id for r in kept if r.doc_id == 4] == [4] and len(kept) == 2
        assert {r.text for r in kept if r.doc_id == 4} == {min(a, upper, key=lambda t: hashlib.sha256(t.encode()).hexdigest())}


def sparse_vectors(number, labels, size=16, pairs=()):
    r = np.random.default_rng(8)
    data = r.normal(size=(number, size))
    for a, b in pairs:
        data[b] = data[a] + 0.01 * r.normal(size=size)
    return [(k, k % labels, [float(x) for x in row]) for k, row in enumerate(data)]


def test_links_too_rare_to_be_audited_are_found(spark, monkeypatch):
    monkeypatch.setattr(vectors, "AUDITED", 3)
    monkeypatch.setattr(vectors, "AUDIT_NUMBERS", 16)
    monkeypatch.setattr(vectors, "ENTRIES", 1)
    monkeypatch.setattr(vectors, "SHARD", 60)
    pairs = [(10, 200), (52, 402)]
    rows = [(i, 0, v) for i, _, v in sparse_vectors(500, 1, pairs=pairs)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: r for r in vectors.near_duplicates(df).collect()}
    assert sorted(i for i, r in got.items() if r.n_links) == [10, 52, 200, 402]
    assert got[200].component_id == 10 and got[402].component_id == 52


def test_very_many_labels_and_columns_that_clash(spark):
    rows = sparse_vectors(4_000, 2_000, size=4, pairs=[(0, 2_000), (7, 2_007), (8, 2_009)])
    names = ("rep", "vector", "times", "shard", "part", "turn", "near", "a", "b", "links", "key", "l", "e", "square")
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for name in names:
        df = df.withColumn(name, F.lit("x"))
    assert vectors._clusters(vectors.classes(df)) == {}
    got = {r.vec_id: r for r in vectors.near_duplicates(df).collect()}
    assert len(got) == 4_000 and got[2_000].component_id == 0 and got[2_007].component_id == 7 and got[2_009].component_id == 2_009
    unit = {i: (label, np.array(v) / np.linalg.norm(v)) for i, label, v in rows}
    for i in range(2_000):
        a, b = unit[i], unit[i + 2_000]
        assert got[i].n_links == int(a[1] @ b[1] >= 0.93)
