"""Vector operators against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import nearest, vector_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, key string, v string, list string"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(7)
    base = rng.normal(size=(60, 24))
    near = base[:40] + rng.normal(size=(40, 24)) * rng.uniform(0.05, 0.5, (40, 1))
    x = np.concatenate([base, near, np.repeat(base[:1], 30, axis=0), base[1:2] * 7]).astype(np.float32)
    labels = [int(v) for v in rng.integers(0, 3, len(x))]
    labels[:3] = labels[60:63] = [0, 0, 0]
    rows = [(i, v.tolist(), lab, "k", "v", "l") for i, (v, lab) in enumerate(zip(x, labels))]
    n = len(rows)
    odd = [(n, None, 0), (n + 1, [0.0] * 24, 0), (n + 2, [float("nan")] * 24, 0), (n + 3, [None] + [1.0] * 23, 0), (n + 4, x[0].tolist(), None), (n + 5, [], 0), (n + 6, [1.0, 2.0], 0), (n + 7, [2.0, 4.0], 0), (n + 8, [float("inf")] + [1.0] * 23, 0)]
    return rows + [(*r, "k", "v", "l") for r in odd]


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v)


@pytest.mark.parametrize("sizes", [{}, {"PER_LIST": 6, "PART": 8, "QUERIES": 16}])
def test_near_duplicates(spark, vectors, sizes, monkeypatch):
    """As it is, and with many lists, parts and deals."""
    for name, n in sizes.items():
        monkeypatch.setattr(vector_dedup, name, n)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(spark.createDataFrame(vectors, SCHEMA)).collect()}
    ids, parent, links = [r[0] for r in vectors], {r[0]: r[0] for r in vectors}, {r[0]: 0 for r in vectors}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in vectors:
        for b in vectors:
            if a[0] < b[0] and a[2] is not None and a[2] == b[2] and usable(a[1]) and usable(b[1]) and len(a[1]) == len(b[1]):
                p, q = np.array(a[1], np.float64), np.array(b[1], np.float64)
                if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.93:
                    links[a[0]] += 1
                    links[b[0]] += 1
                    parent[max(root(a[0]), root(b[0]))] = min(root(a[0]), root(b[0]))
    assert got == {i: (links[i], root(i), root(i) == i) for i in ids} and sum(links.values()) > 300


def test_near_duplicates_of_nothing(spark, vectors):
    assert vector_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    odd = [r for r in vectors if not usable(r[1])]
    got = vector_dedup.near_duplicates(spark.createDataFrame(odd, SCHEMA)).collect()
    assert [(r.n_links, r.kept) for r in got] == [(0, True)] * len(odd)


def test_probes_and_codes_lose_nothing():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16))
    x[1500:] = x[:1500] + rng.normal(size=(1500, 16)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pq, reach = vector_dedup.ProductQuantizer(x[::3], 32), float(np.sqrt(2 - 2 * 0.93))
    lists, far = pq.nearest(x)
    codes, error = pq.encode(x, lists)
    radii = np.array([far[lists == k].max(initial=-1) for k in range(len(pq.coarse))])
    probes = list(pq.probes(x, radii, reach))
    i, j = np.nonzero(x @ x.T >= 0.93)
    assert all(lists[b] in probes[a] for a, b in zip(i.tolist(), j.tolist()))
    for k in range(len(pq.coarse)):
        at = np.flatnonzero(lists == k)
        d = pq.table_distances(x, k, codes[at])
        on = lists[j] == k
        place = {v: p for p, v in enumerate(at.tolist())}
        assert all(d[a, place[b]] <= (reach + error[b] + 1e-4) ** 2 for a, b in zip(i[on].tolist(), j[on].tolist()))
    assert sum(map(len, probes)) < 0.9 * len(x) * len(pq.coarse)


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(nearest.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    h = nearest.CrossPolytope(64, 60_000)
    assert h.axes == [64, 8] and h.buckets == 2048 and h.tables == 16
    both = [np.concatenate([y, -y], axis=1) for y in (h.rotated(x, 0, 0)[:, :64], h.rotated(x, 0, 1)[:, :8])]
    assert (h.nearest_buckets(x, 0)[:, 0] == both[0].argmax(axis=1) * 16 + both[1].argmax(axis=1)).all()
    sums = (both[0][:, :, None] + both[1][:, None]).reshape(5, -1)
    assert (h.nearest_buckets(x, 0, 40) == np.argsort(-sums, axis=1)[:, :40]).all()


def test_buckets_grow_with_the_vectors():
    sizes = [nearest.CrossPolytope(65, n) for n in (1, 60, 500, 2000, 20_000, 60_000, 10**6, 10**9)]
    asked = [h.tables * h.probes * n / h.buckets for h, n in zip(sizes, (1, 60, 500, 2000, 20_000, 60_000, 10**6, 10**9))]
    assert [h.buckets for h in sizes] == sorted(h.buckets for h in sizes) and all(np.prod([2 * m for m in h.axes]) == h.buckets for h in sizes)
    assert asked[2] == 500 and asked[-2] < 10**5 and asked[-1] < 10**6  # scored for a query


@pytest.mark.parametrize("n, k", [(64, 20), (3000, 20)])
def test_search_breaks_ties_by_id(spark, n, k):
    """Very many different vectors of one score: those of the smallest ids come."""
    eye = np.zeros((n + 1, 16))
    eye[0, 0] = 1.0
    rng = np.random.default_rng(1)
    eye[1:, 1:] = rng.integers(-2, 3, (n, 15))
    eye[1:, 0] = 0.5
    ids = [0, *(rng.permutation(n) * 20 + 1).tolist()]
    rows = [(i, v.tolist()) for i, v in zip(ids, eye)]
    got = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tables=1, probes=1 << 20).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(20 * i + 1, 0.5) for i in range(k)]


def test_best_is_exact_and_ordered():
    rng = np.random.default_rng(2)
    x, y, least = rng.integers(-3, 4, (7, 5)).astype(float), rng.integers(-3, 4, (400, 5)).astype(float), rng.permutation(400)
    for k in (1, 21, 500):
        rows, columns, score = nearest._best(x, y, least, k)
        want = [(i, int(least[j]), float(s)) for i in range(7) for s, _, j in sorted((-float(x[i] @ y[j]), least[j], j) for j in range(400))[:k] for s in [-s]]
        assert list(zip(rows.tolist(), least[columns].tolist(), score.tolist())) == want


@pytest.mark.parametrize("n", [1200, 1400])
def test_search_of_repeated_ids(spark, n):
    x = np.random.default_rng(3).normal(size=(n, 8))
    rows = [(i // 2, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist())] * 5
    got = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tables=1, probes=1 << 20)
    s = np.maximum(x @ x[40], x @ x[41])  # an id of two vectors asks with both
    want = [(i // 2, float(s[i])) for i in np.argsort(-s, kind="stable") if i // 2 != 20][:20]
    rows = got.where("query_id = 20").orderBy("rank").collect()
    assert [r.vec_id for r in rows] == [i for i, _ in want] and np.allclose([r.score for r in rows], [v for _, v in want])


def brute_search(rows, k=20):
    out = {}
    for q in rows:
        if q[0] % 20 == 0 and usable(q[1]):
            scores = [(-float(np.array(q[1], np.float64) @ np.array(r[1], np.float64)), r[0]) for r in rows if r[0] != q[0] and usable(r[1]) and len(r[1]) == len(q[1])]
            out[q[0]] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_search_of_few_vectors_is_exact(spark, vectors):
    rows = [r for r in vectors if r[0] is not None]
    got: dict = {}
    for r in nearest.search(spark.createDataFrame(rows, SCHEMA)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = {q: v for q, v in brute_search(rows).items() if v}
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-9)
    assert nearest.search(spark.createDataFrame([], SCHEMA)).collect() == []


def test_search_recall(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 32)).astype(np.float32) * rng.uniform(0.5, 1.5, (4000, 1)).astype(np.float32)
    rows = [(i, v.tolist(), 0, "k", "v", "l") for i, v in enumerate(x)]
    found: dict = {}
    for r in nearest.search(spark.createDataFrame(rows, SCHEMA)).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    y, hits = x.astype(np.float64), 0
    for q in range(0, 4000, 20):
        s = y @ y[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits / (200 * 20) >= 0.9


@pytest.mark.parametrize("kind", ["outlier", "spread"])
def test_search_recall_whatever_the_norms(spark, kind):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 32))
    if kind == "outlier":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x[7] *= 10
    else:
        x *= np.exp(rng.normal(size=(4000, 1)))
    found: dict = {}
    for r in nearest.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 4000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert all(len(v) == 20 for v in found.values()) and len(found) == 200
    assert hits / (200 * 20) >= 0.9


def test_search_fills_up_where_buckets_hold_too_little(spark):
    x = np.random.default_rng(9).normal(size=(2000, 32))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = nearest.search(rows, tables=1, probes=2).groupBy("query_id").count().collect()
    assert [r["count"] for r in got] == [20] * 100
