"""Embedding near-duplicates by a robust-pruned flat graph.

Vectors of a label are dealt to overlapping cluster shards, each vector to its two nearest clusters, the
nearer of which owns it. In every shard each vector gets neighbours by robust pruning, and the lists that
a vector gets in different shards are united, each with some neighbours from anywhere in the shard. A vector
then searches the shards nearest to it: greedily along the graph from its own node and from members that lie
far from each other, and on from everything within range until nothing in range is left to expand. Cosines are taken in double precision, so what is reported is verified. An audit compares
a bounded sample of vectors with brute force, at every size of table. If any size of group lacks links, the search is
repeated with more shards and expansions, and in the end with all pairs of what meets in a shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import saved
from perigee.llm.components import connected_components

LEAST_COSINE = 0.93
#: Vectors meant for a shard, the most one may have before it is dealt to parts, and all clusters together.
SHARD, SHARD_MOST, CLUSTERS_MOST = 1000, 3000, 4096
#: Vectors that clusters are fitted on, at most, and rounds of fitting.
FIT_ROWS, FIT_ROUNDS = 40_000, 8
#: Robust pruning: neighbours of a vector, and how much nearer a detour must be to drop one.
DEGREE, ALPHA = 24, 1.2
#: First neighbours of a vector that get it as a neighbour too.
RETURNS = 2
#: Neighbours of a vector from anywhere in the shard; members that every search starts at.
FAR, ENTRIES = 4, 32
#: Expansions of a search before only vectors in range are expanded; searches run together.
EXPANSIONS, TOGETHER = 16, 1000
#: Shards searched at first; vectors audited at first; mean share of a vector's links that must be found.
PROBES, AUDITED, LEAST_RECALL = 4, 256, 0.98
#: The audit grows until it has ENOUGH vectors with fewer than FEW links, or all vectors, or so many numbers.
ENOUGH, FEW, AUDIT_NUMBERS = 64, 8, 1 << 20


def classes(vectors: DataFrame) -> DataFrame:
    """``rep, label, vector, times``: distinct usable vectors of a label, normalised, with the smallest id and number of rows."""
    square = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    sound = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).filter(sound)
    usable = usable.withColumn("square", square).filter("square > 0 AND square < double('Infinity')")
    each = usable.groupBy("label", "embedding").agg(
        F.min(F.col("vec_id").cast("long")).alias("rep"), F.count("*").alias("times"), F.first("square").alias("square")
    )
    unit = F.transform("embedding", lambda x: x.cast("double") / F.sqrt("square"))
    space = F.concat_ws(":", "label", F.size("embedding"))  # vectors of another length are like another label
    return each.select("rep", space.alias("label"), unit.alias("vector"), "times")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _clusters(nodes: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Unit centres by label and length of the vectors, fitted on a bounded sample.

    Only labels with several shards are in it, at most half as many as there may be clusters; all others have shard 0.
    """
    total = nodes.count()
    counted = nodes.groupBy("label", F.size("vector").alias("size")).count()
    large = counted.filter((F.col("count") > SHARD) & (F.col("count") * CLUSTERS_MOST >= 2 * total)).collect()
    wanted = {(r["label"], r["size"]): min(-(-r["count"] // SHARD), CLUSTERS_MOST * r["count"] // total) for r in large}
    if not wanted:
        return {}
    many = sum(r["count"] for r in large)
    share = min(1.0, FIT_ROWS / many)
    some = nodes.filter(F.col("label").isin(sorted({label for label, _ in wanted})))
    some = some.filter(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(FIT_ROWS)
    rows = some.select("label", F.size("vector").alias("size"), "vector").toPandas()
    out = {}
    for key, mine in rows.groupby(["label", "size"]):
        k = wanted.get(key, 1)
        if k == 1 or len(mine) <= k:
            continue
        data = np.stack(mine["vector"].tolist())
        centres = data[np.random.default_rng(5).choice(len(data), k, replace=False)]
        for _ in range(FIT_ROUNDS):
            near = (data @ centres.T).argmax(axis=1)
            for c in range(k):
                if (near == c).any():
                    centre = data[near == c].sum(axis=0)
                    centres[c] = centre / max(np.linalg.norm(centre), 1e-12)
        out[key] = centres
    return out


def _dealt(nodes: DataFrame, clusters: dict, most: int) -> DataFrame:
    """``rep, label, vector, times, shard, turn``: the ``most`` nearest clusters of each vector, nearest first."""

    def run(batches):
        for batch in batches:
            labels, vectors = batch.column("label").to_pylist(), batch.column("vector").to_pylist()
            row, shard, turn = [], [], []
            for i, (label, vector) in enumerate(zip(labels, vectors, strict=True)):
                centres = clusters.get((label, len(vector)))
                near = np.zeros(1, int) if centres is None else np.argsort(-(centres @ np.array(vector)), kind="stable")[:most]
                row += [i] * len(near)
                shard += near.tolist()
                turn += range(len(near))
            part = batch.take(pa.array(row, pa.int64()))
            columns = [*part.columns, pa.array(shard, pa.int32()), pa.array(turn, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["rep", "label", "vector", "times", "shard", "turn"])

    columns = nodes.select("rep", "label", "vector", "times")
    return columns.mapInArrow(run, "rep long, label string, vector array<double>, times long, shard int, turn int")


def _pruned(vectors: np.ndarray) -> np.ndarray:
    """Robust pruning with all other vectors as candidates: up to DEGREE neighbours of each row, -1 for none."""
    n = len(vectors)
    distance = np.sqrt(np.maximum(2 - 2 * (vectors @ vectors.T), 0)).astype(np.float32)
    left = distance.copy()
    np.fill_diagonal(left, np.inf)
    out = np.full((n, DEGREE), -1, np.int64)
    for k in range(min(DEGREE, n - 1)):
        pick = left.argmin(axis=1)
        has = np.isfinite(left[np.arange(n), pick])
        if not has.any():
            break
        out[has, k] = pick[has]
        left[ALPHA * distance[pick] <= distance] = np.inf
        left[np.arange(n), pick] = np.inf
    return out


def _graph(table: pa.Table) -> pa.Table:
    """Neighbours of each vector within one part of a shard."""
    table = table.sort_by("rep")
    reps = table["rep"].to_numpy()
    near = _pruned(_matrix(table["vector"]))
    lists = [reps[row[row >= 0]].tolist() for row in near]
    # as pruning lets a vector lose all lists it was on, each gets onto those of its own first neighbours
    for i, row in enumerate(near[:, :RETURNS].tolist()):
        for j in row:
            if j >= 0 and reps[i] not in lists[j]:
                lists[j].append(int(reps[i]))
    # within a dense group all pruned lists stay inside the group
    far = np.random.default_rng(5).integers(0, len(reps), (len(reps), FAR)).tolist()
    for i, row in enumerate(far):
        lists[i] += [int(reps[j]) for j in dict.fromkeys(row) if j != i and reps[j] not in lists[i]]
    return pa.table({"rep": reps, "near": pa.array(lists, pa.list_(pa.int64()))})


def _spread(vectors: np.ndarray) -> np.ndarray:
    """The medoid, and members each as far as can be from those before it."""
    entries = [int((vectors @ vectors.mean(axis=0)).argmax())]
    nearest = vectors @ vectors[entries[0]]
    while len(entries) < min(ENTRIES, len(vectors)):
        entries.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[entries[-1]])
        nearest[entries] = np.inf
    return np.array(entries)


def _found(table: pa.Table, expansions: int | None = EXPANSIONS) -> pa.Table:
    """Links of the searching rows of one part of a shard to the rows it owns; without ``expansions``, by all pairs.

    Rows: ``a, b`` edges of a spanning forest of the links, and ``a, links`` with the rows linked.
    """
    member = table.filter(table["near"].is_valid()).sort_by("rep")
    search = table.filter(table["near"].is_null())
    if not len(member) or not len(search):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
    reps, vectors, times = member["rep"].to_numpy(), _matrix(member["vector"]), member["times"].to_numpy()
    owned = member["turn"].to_numpy() == 0
    place = {r: i for i, r in enumerate(reps.tolist())}
    near = [[place[r] for r in row if r in place] for row in member["near"].to_pylist()]
    width = max(map(len, near), default=0)
    graph = np.array([row + [-1] * (width - len(row)) for row in near], np.int64).reshape(len(near), width)
    entries = _spread(vectors)
    who, queries = search["rep"].to_numpy(), _matrix(search["vector"])
    edges_a, edges_b, edges_n = [], [], []
    for at in range(0, len(who), TOGETHER):
        ids = who[at : at + TOGETHER]
        own = np.array([place.get(r, -1) for r in ids.tolist()])
        some = queries[at : at + TOGETHER]
        if expansions is None:
            inside = (some @ vectors.T >= LEAST_COSINE) & owned
        else:
            inside = _searched(vectors, graph, entries, own, some, expansions) & owned
        inside[np.flatnonzero(own >= 0), own[own >= 0]] = False
        counts = inside @ times
        some = np.flatnonzero(counts)
        edges_a += ids[some].tolist()
        edges_b += [None] * len(some)
        edges_n += counts[some].tolist()
        for a, b in _forest(inside, ids, reps):
            edges_a.append(a)
            edges_b.append(b)
            edges_n.append(None)
    return pa.table({"a": pa.array(edges_a, pa.int64()), "b": pa.array(edges_b, pa.int64()), "links": pa.array(edges_n, pa.int64())})


def _searched(
    vectors: np.ndarray, graph: np.ndarray, entries: np.ndarray, own: np.ndarray, queries: np.ndarray, expansions: int
) -> np.ndarray:
    """Which vectors each query finds in range: best-first from the entries and its own node, then on through all in range.

    ``own`` is the place of each query among the vectors, -1 for none.
    """
    n, many = len(vectors), len(queries)
    cosine = np.full((many, n + 1), -2.0)
    waiting = np.full((many, n + 1), -2.0)  # cosines of what is seen and not expanded
    cosine[:, entries] = waiting[:, entries] = queries @ vectors[entries].T
    here = np.flatnonzero(own >= 0)
    cosine[here, own[here]] = waiting[here, own[here]] = 1.0
    active, step = np.arange(many), 0
    padded = np.vstack([vectors, np.zeros(vectors.shape[1])])
    while len(active):
        best = waiting[active].argmax(axis=1)
        value = waiting[active, best]
        go = value > -2.0 if step < expansions else value >= LEAST_COSINE
        active, best = active[go], best[go]
        if not len(active):
            break
        waiting[active, best] = -2.0
        near = graph[best]
        fresh = (near >= 0) & (cosine[active[:, None], near] == -2.0)
        near = np.where(fresh, near, n)
        row, col = np.nonzero(fresh)
        found = np.einsum("ij,ij->i", queries[active[row]], padded[near[row, col]])
        cosine[active[row], near[row, col]] = found
        waiting[active[row], near[row, col]] = found
        step += 1
    return cosine[:, :n] >= LEAST_COSINE


def _forest(inside: np.ndarray, ids: np.ndarray, reps: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join what the links join: fewer than there are queries and members."""
    rows, columns = np.flatnonzero(inside.any(axis=1)), np.flatnonzero(inside.any(axis=0))
    part = inside[np.ix_(rows, columns)]
    left_rows, left_columns = np.ones(len(rows), bool), np.ones(len(columns), bool)
    edges: list[tuple[int, int]] = []
    for first in range(len(rows)):
        stack = [first] if left_rows[first] else []
        left_rows[first] = False
        while stack:
            r = stack.pop()
            for c in np.flatnonzero(part[r] & left_columns).tolist():
                left_columns[c] = False
                edges.append((int(ids[rows[r]]), int(reps[columns[c]])))
                more = np.flatnonzero(part[:, c] & left_rows)
                left_rows[more] = False
                edges += [(int(ids[rows[m]]), int(reps[columns[c]])) for m in more.tolist()]
                stack += more.tolist()
    return edges


def _links(nodes: DataFrame, clusters: dict, members: DataFrame, probes: int, expansions: int | None) -> DataFrame:
    """``a, b, links`` as ``_found`` gives them, over all parts of all shards."""
    searching = _dealt(nodes, clusters, probes).drop("turn")
    # a shard with too many members is dealt to parts; every part is searched, by groups of searching rows
    sizes = members.groupBy("label", "shard", "part").agg(F.first("parts").alias("parts"))
    asked = searching.groupBy("label", "shard").agg(F.ceil(F.count("*") / (4 * SHARD_MOST)).cast("int").alias("groups"))
    sizes = saved(sizes.join(asked, ["label", "shard"]), "vector-parts")
    group = F.pmod(F.xxhash64("rep"), F.col("groups")).cast("int")
    questions = searching.join(sizes.select("label", "shard", "part", "groups"), ["label", "shard"]).withColumn("group", group)
    holding = members.join(sizes.select("label", "shard", "part", "groups"), ["label", "shard", "part"])
    holding = holding.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    columns = ["label", "shard", "part", "group", "rep", "vector", "times"]
    both = holding.select(*columns, "turn", "near").union(
        questions.select(*columns, F.lit(None).cast("int"), F.lit(None).cast("array<long>"))
    )

    def run(table: pa.Table) -> pa.Table:
        return _found(table, expansions)

    return both.groupBy("label", "shard", "part", "group").applyInArrow(run, "a long, b long, links long")


def _true_links(nodes: DataFrame, many: int) -> DataFrame:
    """``a, n``: rows truly linked to each of ``many`` vectors that link; they meet all rows in blocks."""
    some = nodes.orderBy(F.xxhash64("rep")).limit(many).select("rep", "label", "vector").toPandas()
    asked = {}
    for label, mine in some.groupby("label"):
        asked[label] = mine["rep"].to_numpy(), np.stack(mine["vector"].tolist())

    def run(batches):
        for batch in batches:
            reps, times = batch.column("rep").to_numpy(), batch.column("times").to_numpy()
            labels, vectors = np.array(batch.column("label").to_pylist(), object), batch.column("vector").to_pylist()
            for label, (ids, against) in asked.items():
                mine = np.flatnonzero(labels == label)
                block = max(1, (1 << 20) // len(ids))
                for at in range(0, len(mine), block):
                    rows = mine[at : at + block]
                    hit = against @ np.array([vectors[i] for i in rows.tolist()]).T >= LEAST_COSINE
                    hit &= ids[:, None] != reps[rows]
                    n = hit @ times[rows]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[n > 0]), pa.array(n[n > 0])], names=["a", "n"])

    truth = nodes.select("rep", "label", "vector", "times").mapInArrow(run, "a long, n long")
    return truth.groupBy("a").agg(F.sum("n").alias("n"))


def _audited(nodes: DataFrame) -> DataFrame:
    """``a, n`` for vectors enough to judge small groups by, as far as the bound on the sample goes."""
    total, width = nodes.agg(F.count("*"), F.max(F.size("vector"))).first()
    most, many = min(total, max(AUDITED, AUDIT_NUMBERS // max(width or 1, 1))), min(total, AUDITED)
    while True:
        truth = saved(_true_links(nodes, many), "vector-audit")
        if many >= most or truth.filter(F.col("n") < FEW).count() >= ENOUGH:
            return truth
        many = min(most, 4 * many)


def _recall(truth: DataFrame, counts: DataFrame) -> float | None:
    """Mean share of an audited vector's true links that ``a, links`` has: the least over powers of four of their number.

    None where no audited vector links: then nothing was measured.
    """
    share = F.least("n", F.coalesce("links", F.lit(0))) / F.col("n")
    strata = truth.join(counts, "a", "left").groupBy(F.floor(F.log2("n") / 2)).agg(F.avg(share).alias("share"))
    return strata.agg(F.min("share")).first()[0]


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (vec_id, embedding, label).

    Rows link within a label, and only vectors of the same length. Null labels, and vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do those whose sum of squares is beyond a
    double or rounds to zero. Where none of the audited vectors links, all pairs are compared. Equal vectors of a label are one
    node, so groups of copies cost one row; each counts the others. Repeated rows count as copies. A null
    vec_id links with nothing, has a null component and is not kept. Other columns are not read.
    """
    nodes = saved(classes(vectors), "vector-classes")
    clusters = _clusters(nodes)
    most = max((len(c) for c in clusters.values()), default=1)
    dealt = saved(_dealt(nodes, clusters, 2), "vector-shards")
    sizes = dealt.groupBy("label", "shard").agg(F.ceil(F.count("*") / SHARD_MOST).cast("int").alias("parts"))
    parted = dealt.join(sizes, ["label", "shard"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    lists = parted.groupBy("label", "shard", "part").applyInArrow(_graph, "rep long, near array<long>")
    united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    members = saved(parted.join(united, "rep"), "vector-graph")
    truth = _audited(nodes)
    probes, expansions = PROBES, EXPANSIONS
    while True:
        found = saved(_links(nodes, clusters, members, probes, expansions), "vector-links")
        counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
        # all pairs of all shards are all there are
        if probes >= most and expansions is None:
            break
        recall = _recall(truth, counts)
        if recall is not None and recall >= LEAST_RECALL:
            break
        if recall is None:  # links too rare to audit: take all pairs
            probes, expansions = most, None
        else:
            probes, expansions = 2 * probes, 4 * EXPANSIONS if expansions == EXPANSIONS else None
    labels = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    known = nodes.join(counts, F.col("rep") == F.col("a"), "left").join(labels, F.col("rep") == F.col("node"), "left")
    known = known.select(
        "rep", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    usable = classes_of(vectors)
    rows = usable.join(known, "rep", "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def classes_of(vectors: DataFrame) -> DataFrame:
    """``vec_id, rep`` for every row: the smallest id with the same vector and label, null for rows that link with nothing."""
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding", "label")
    square = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    sound = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & (square > 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & sound, F.lit(False))
    key = F.xxhash64("label", "embedding")
    reps = rows.filter(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"))
    reps = reps.select(F.xxhash64("label", "embedding").alias("key"), F.col("label").alias("l"), F.col("embedding").alias("e"), "rep")
    keyed = rows.withColumn("key", F.when(usable, key))
    same = (keyed["key"] == reps["key"]) & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e"))
    return keyed.join(reps, same, "left").select("vec_id", "rep")
