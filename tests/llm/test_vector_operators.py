"""The vector operators against brute force, with hard rows."""

import random

import numpy as np
import pytest

from brontide.llm import topk_search, vector_dedup
from brontide.llm.components import components

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, cell int, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, 0.5) for i, v, label in rows], SCHEMA)


def clustered(n, d, seed=0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(1, n // 6), d))
    x = centres[r.integers(0, len(centres), n)] + r.normal(size=(n, d)) * r.choice([0.0, 0.1, 0.25], (n, 1))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype("f4")


ODD = [(2000, None, 1), (2001, [], 1), (2002, [NAN] + [0.0] * 15, 1), (2003, [INF] + [0.0] * 15, 1), (2004, [None] + [0.1] * 15, 1), (2005, [0.0] * 16, 1), (2006, [0.1] * 3, 1), (2100, [0.2] * 3, None), (None, [0.1] * 16, 1)]


@pytest.mark.parametrize("shard", [20_000, 40])
def test_top_k_is_exact(spark, shard):
    x = clustered(400, 16)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)] + [(500 + i, x[0].tolist(), 0) for i in range(60)] + ODD
    got = {}
    for r in topk_search.top_k(vectors(spark, rows), 50, 5, shard).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = {i: [int(np.floor(np.float64(np.float32(c)) * 256)) for c in v] for i, v, _ in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)}
    want = {}
    for q in good:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(good[q], good[c], strict=True)), c) for c in good if c != q and len(good[c]) == len(good[q]))
            if scores:
                want[q] = [(k + 1, c, -s) for k, (s, c) in enumerate(scores[:5])]
    assert {q: sorted(v) for q, v in got.items()} == want and 2100 in got


def test_tree_bounds_hold():
    r = np.random.default_rng(1)
    rows = np.floor(r.normal(size=(700, 8)) * 256)
    tree, q = topk_search.Tree(np.arange(700), rows), np.floor(r.normal(size=(20, 8)) * 256)
    bounds = tree.bounds(q)
    for node, leaf in enumerate(tree.leaves):
        if leaf is not None:
            assert ((rows[leaf] @ q.T).max(0) <= bounds[:, node] + 1e-6).all()
    for i in range(20):
        order = sorted((-s, c) for c, s in enumerate(rows @ q[i]))[:5]
        assert tree.search(q[i], -1, bounds[i], 5, -np.inf) == [(int(-s), c) for s, c in order]


@pytest.mark.parametrize("queries", [4_096, 7])
def test_top_k_with_repeated_ids_and_large_components(spark, monkeypatch, queries):
    """Rows are told apart, not ids; scores beyond 2**53 are compared exactly; a few long vectors attract all queries."""
    monkeypatch.setattr(topk_search, "QUERIES", queries)
    x = clustered(200, 8, 4)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(50, x[3].tolist(), 0), (50, x[50].tolist(), 0), (50, x[50].tolist(), 0), (7, x[50].tolist(), 0)]
    rows += [(300 + i, (x[i] * 3e6).tolist(), 0) for i in range(6)] + [(400, [2.0**22 + 1] + [1.0] * 7, 0), (401, [2.0**22] + [1.0] * 7, 0), (402, [2.0**22 + 1] + [1.0] * 6 + [1.25], 0), (403, [2.0**30] * 8, 0)]
    out = topk_search.top_k(vectors(spark, rows), 50, 5, 40).collect()
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out)
    whole = [[int(np.floor(np.float64(np.float32(c)) * 256)) for c in v] for _, v, _ in rows]
    want = []
    for i, (q, *_) in enumerate(rows):
        if q % 50 == 0:
            scores = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(whole[i], whole[j], strict=True)))), rows[j][0]) for j in range(len(rows)) if j != i)
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(scores[:5])]
    assert got == sorted(want) and len(got) == 5 * sum(r[0] % 50 == 0 for r in rows)


def brute_links(rows, least):
    out, of = {}, {i: i for i, *_ in rows}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    ok = {i: np.array(v, "f8") for i, v, label in rows if v and label is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)}
    labels = {i: label for i, _, label in rows}
    for i in of:
        out[i] = sum(1 for j in ok if j != i and i in ok and labels[i] == labels[j] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= least)
        for j in ok:
            if i in ok and j < i and labels[i] == labels[j] and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] / np.linalg.norm(ok[i]) / np.linalg.norm(ok[j]) >= least:
                of[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (out[i], root(i)) for i in of}


@pytest.mark.parametrize("block", [1_500, 16])
def test_near_duplicates_find_all_links(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    x = clustered(300, 16, 3)
    rows = [(i, v.tolist(), i % 2 if i % 17 else None) for i, v in enumerate(x)] + [(500 + i, x[1].tolist(), 1) for i in range(40)] + [(600, (x[1] * 3).tolist(), 1)] + [r for r in ODD if r[0] is not None]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(vectors(spark, rows), 0.93).collect()}
    want = brute_links([(i, v if v is None else [None if c is None else float(np.float32(c)) for c in v], label) for i, v, label in rows], 0.93)
    found, there = sum(n for n, *_ in got.values()), sum(n for n, _ in want.values())
    assert len(got) == len(rows) and all(got[i][0] <= want[i][0] for i in want) and found >= 0.995 * there > 0
    assert all(got[i] == (0, i, True) for i in (2000, 2001, 2002, 2003, 2004, 2005, 2100))
    if found == there:
        assert {i: g[:2] for i, g in got.items()} == want


def test_near_duplicates_tell_rows_apart_by_vector_and_label(spark):
    a, b, far = [1.0] + [0.1] * 7, [1.0] + [0.11] * 7, [-1.0] + [0.5] * 7
    rows = [(5, a, 1), (5, b, 1), (6, b, 1), (5, a, 2), (5, a, 2), (None, a, 1), (None, far, 1), (9, far, None), (8, [-0.0, 1.0], 3), (7, [0.0, 1.0], 3)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(vectors(spark, rows), 0.93).collect()), key=str)
    want = [(5, 3, 5, True), (5, 3, 5, True), (6, 3, 5, False), (5, 1, 5, True), (5, 1, 5, True), (None, 3, 5, False), (None, 0, None, False), (9, 0, 9, True), (8, 1, 7, False), (7, 1, 7, True)]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("hashes", [3, 4])
def test_recall_at_the_threshold_does_not_fall_with_hashes(spark, hashes):
    r, n = np.random.default_rng(8), 1_000
    x, y = r.normal(size=(2, n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.9301 * x + np.sqrt(1 - 0.9301**2) * y
    rows = [(2 * i + k, v[i].tolist(), 1) for i in range(n) for k, v in enumerate((x, y))]
    got = {r.vec_id: r.n_links for r in vector_dedup.near_duplicates(vectors(spark, rows), 0.93, hashes=hashes).collect()}
    assert set(got.values()) <= {0, 1} and sum(got.values()) >= 0.996 * 2 * n


def test_tables_grow_with_hashes_and_dimensions():
    assert vector_dedup.tables_for(64, 0.93, 1) == 10 <= vector_dedup.tables_for(64, 0.93, 2) < vector_dedup.tables_for(64, 0.93, 3) < vector_dedup.tables_for(64, 0.93, 4) < vector_dedup.tables_for(128, 0.93, 4)


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    y = vector_dedup.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(vector_dedup.hadamard(y), x)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)] + [(5, 5), (7, 6)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    of = {n: n for e in edges for n in e}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for a, b in edges:
        of[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {n: root(n) for n in of}


def test_empty_tables(spark):
    none = vectors(spark, [])
    assert topk_search.top_k(none).isEmpty() and vector_dedup.near_duplicates(none).isEmpty()
