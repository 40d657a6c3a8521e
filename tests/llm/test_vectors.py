"""Embedding operators against brute force."""

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from strandlake.llm import near_vectors, vector_graph, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, node long, cell string, n long, key binary"


@pytest.fixture(scope="session")
def embeddings(spark):
    """Rows (vec_id, vector, label) with further columns whose names clash with the operators' own."""
    def make(rows):
        data = [(i, None if v is None else [None if c is None else float(c) for c in v], k, 1, "c", 2, b"k") for i, v, k in rows]
        return spark.createDataFrame(data, SCHEMA)

    return make


def unit(rng, n, d=64):
    x = rng.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1)[:, None]


def copies(rng, x, low, high):
    """A vector for each of x whose cosine with it lies between low and high."""
    away = unit(rng, len(x), x.shape[1])
    away -= (away * x).sum(1)[:, None] * x
    away /= np.linalg.norm(away, axis=1)[:, None]
    c = rng.uniform(low, high, len(x))[:, None]
    return c * x + np.sqrt(1 - c**2) * away


def brute(rows, threshold=near_vectors.THRESHOLD):
    """(n_links, component) by row, as lists of the rows' places."""
    usable = defaultdict(list)
    for p, (_, v, label) in enumerate(rows):
        if v and label is not None and all(c is not None and math.isfinite(c) for c in v) and any(v):
            usable[label, len(v)].append(p)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for places in usable.values():
        x = np.array([rows[p][1] for p in places], "f4").astype("f8")
        x /= np.linalg.norm(x, axis=1)[:, None]
        near = x @ x.T >= threshold
        for a, b in zip(*np.nonzero(near), strict=True):
            if a != b:
                links[places[a]] += 1
                p, q = find(places[a]), find(places[b])
                parent[max(p, q)] = min(p, q)
    groups = defaultdict(list)
    for p in range(len(rows)):
        groups[find(p)].append(rows[p][0])
    return [(i, links[p], min((x for x in groups[find(p)] if x is not None), default=None)) for p, (i, _, _) in enumerate(rows)]


def check(found, rows):
    got = [tuple(r) for r in found.select("vec_id", "n_links", "component_id", "kept").collect()]
    assert all(k == (i == c) for i, _, c, k in got)
    assert sorted((r[:3] for r in got), key=str) == sorted(brute(rows), key=str)


def test_graph_finds_near_copies_and_bounds_degrees():
    rng = np.random.default_rng(1)
    x = unit(rng, 900)
    both = np.concatenate([x, copies(rng, x[:300], 0.93, 0.99)]).astype("f4")
    edges = vector_graph.build(both)
    assert edges.shape == (len(both), vector_graph.DEGREE)
    assert all(i not in edges[i] and len(set(e[e >= 0])) == (e >= 0).sum() for i, e in enumerate(edges))
    ids, _ = vector_graph.greedy(both, edges, vector_graph.medoid(both), both[900:])
    assert np.mean([i in found for i, found in enumerate(ids)]) >= 0.97


@pytest.mark.parametrize("capacity", [2048, 128])
def test_near_vectors(embeddings, monkeypatch, capacity):
    """Isolated pairs, chains, a dense group and scaled copies; with the smaller capacity in many shards, with groups over their size."""
    monkeypatch.setattr(near_vectors, "CAPACITY", capacity)
    monkeypatch.setattr(near_vectors, "TARGET", max(64, capacity // 2))
    monkeypatch.setattr(near_vectors, "SAMPLE", 2 * capacity)
    rng = np.random.default_rng(2)
    x = unit(rng, 500)
    chain = [x[499]]
    for _ in range(6):
        chain.append(copies(rng, chain[-1][None], 0.935, 0.94)[0])
    dense = copies(rng, np.repeat(x[:1], 250, 0), 0.985, 0.999)
    wide = copies(rng, np.repeat(x[1:2], 60, 0), 0.95, 0.97)  # not all linked with one another
    vectors = np.concatenate([x, copies(rng, x[100:200], 0.95, 0.99), copies(rng, x[200:260], 0.90, 0.925), chain, dense, wide, 3 * x[:40], x[:40]])
    rows = [(int(i), v.astype("f4").tolist(), int(i % 5 == 0)) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]
    expected, found = sorted(brute(rows)), near_vectors.near_vectors(embeddings(rows))
    got = sorted(tuple(r) for r in found.select("vec_id", "n_links", "component_id").collect())
    assert [r[0] for r in got] == [r[0] for r in expected]
    assert all(g[1] <= e[1] for g, e in zip(got, expected, strict=True))  # no link below the threshold
    total = sum(e[1] for e in expected)
    assert sum(g[1] for g in got) >= 0.99 * total
    assert sum(g[2] != e[2] for g, e in zip(got, expected, strict=True)) <= 0.01 * len(rows)
    recall = near_vectors.audit_recall(embeddings(rows), found).first()
    assert recall["queries"] == near_vectors.AUDITED and recall["recall"] >= 0.97


def test_near_vectors_odd_rows(embeddings):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.1], 0), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], None), (6, None, 0), (7, [], 0), (8, [0.0, 0.0], 0), (9, [nan, 1.0], 0),
        (10, [inf, 1.0], 0), (11, [None, 1.0], 0), (12, [1.0, 0.0, 0.0], 0), (12, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (None, [0.0, 1.0], 0), (13, [-1.0, 0.0], 0), (14, [1e-38, 0.0], 0), (15, [3e38, 3e37], 0),
    ]
    check(near_vectors.near_vectors(embeddings(rows)), rows)
    assert near_vectors.near_vectors(embeddings(rows).limit(0)).count() == 0
    check(near_vectors.near_vectors(embeddings(rows[4:9])), rows[4:9])


def whiten_brute(rows, k=whitening.COMPONENTS):
    """(n, exact deviation by id, |whitened| by id, explained) with numpy's symmetric eigenvectors."""
    keep = [(i, v) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in keep]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(row, s, strict=True)) for row in x]
    centred = np.array([[float(Fraction(n * c - t, n)) for c, t in zip(row, s, strict=True)] for row in x])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, deviation, centred @ v / np.sqrt(e), e / np.trace(centred.T @ centred / n), [i for i, _ in keep]


def test_whitening(embeddings):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), None) for i, v in enumerate((rng.normal(size=(300, 12)) * np.arange(1, 13) * 0.1).astype("f4"))]
    bad = [(900, None, 0), (901, [], 0), (902, [None] * 12, 0), (903, [float("nan")] * 12, 0), (904, [float("inf")] * 12, 0)]
    n, deviation, z, explained, ids = whiten_brute(rows)
    got = whitening.whiten(embeddings(rows + bad).repartition(7)).toPandas()
    assert len(got) == 8 * n and set(got["n"]) == {n} and set(got["vec_id"]) == set(ids)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9
    for c in range(8):
        part = got[got["component"] == c + 1].set_index("vec_id").loc[ids]
        assert [int(x) for x in part["deviation"]] == deviation
        w = part["whitened"].to_numpy()
        assert np.allclose(w * np.sign(w[0]), z[:, c] * np.sign(z[0, c]), atol=1e-8)
        assert np.allclose(part["explained"], explained[c], rtol=1e-9)


def test_whitening_odd_tables(embeddings):
    assert whitening.whiten(embeddings([]).limit(0)).count() == 0
    assert whitening.whiten(embeddings([(1, [1.0, 2.0], 0)])).count() == 0
    assert whitening.whiten(embeddings([(1, [1.0, 2.0], 0)] * 5)).count() == 0
    flat = whitening.whiten(embeddings([(i % 3, [float(i), 2.0 * i], 0) for i in range(6)])).collect()  # rank one, ids repeat
    assert len(flat) == 6 and {r["component"] for r in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-9
    mixed = whitening.whiten(embeddings([(1, [1.0], 0), (2, [1.0, 5.0], 0), (None, [2.0, 3.0], 0)])).collect()
    assert {r["vec_id"] for r in mixed} == {2, None} and {r["n"] for r in mixed} == {2}


def test_whitening_of_large_numbers_is_exact(embeddings):
    rows = [(i, [3e7 * (i + 1), -2e7 * i * i], 0) for i in range(5)]
    _, deviation, *_ = whiten_brute(rows)
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(embeddings(rows)).filter("component = 1").collect()}
    assert [got[i] for i in range(5)] == deviation
    n, total = whitening.sums(*whitening.vectors(embeddings([(i, [1e30, -1e30], 0) for i in range(4)]), "vec_id", "embedding"))
    assert n == 4 and total == [4 * (whitening.MOST + whitening.SHIFT), 4 * (whitening.SHIFT - whitening.MOST)]


def test_merging_many_factors(embeddings, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(200, 6)).astype("f4"))]
    got = whitening.whiten(embeddings(rows).repartition(9)).toPandas()
    assert got["component"].max() == 6 and got["identity_error"].max() < 1e-9
