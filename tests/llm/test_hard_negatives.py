"""Hard negatives against brute force in whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id string, v string, key string, block string"


def brute(rows, k=5, n=10, low=30, high=90):
    """Repeated rows are candidates each, but one anchor."""
    use = [(i, tuple(math.floor(256 * x) for x in v), lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, lab in {r for r in use if r[0] % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other == lab) for j, w, other in use if j != i and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2]][:k]:
            found = [(t, m) for t, m, same in scored if not same and low * -s <= 100 * -t <= high * -s][:n]
            out += [(i, j, r, m, -s, -t) for r, (t, m) in enumerate(found, 1)]
    return sorted(out)


def rows_of(seed, n=700, d=12, scale=1.0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, d)) * scale, 2)
    x[100:160] = x[100]  # ties, the anchor 100 among them
    x[300:420] = x[300]
    labels = rng.integers(0, 3, n)
    labels[300:420] = np.arange(120) % 3
    rows = [(i, v.tolist(), int(lab)) for i, (v, lab) in enumerate(zip(x, labels))]
    rows += [rows[200], rows[200], rows[5], rows[5], (200, rows[7][1], 1), (-100, rows[8][1], -1)]  # repeated rows, an id of two vectors
    rows += [(800, None, 0), (900, [1.0] * d, None), (None, [1.0] * d, 0), (1000, [float("nan")] * d, 0), (1001, [None] + [1.0] * (d - 1), 0), (1002, [float("inf")] + [1.0] * (d - 1), 0)]
    return rows + [(1100, [0.0] * d, 0), (1200, [], 0), (1201, [], 0), (1202, [], 1), (1300, [1.0, 2.0], 0), (1301, [2.0, 1.0], 0), (1302, [1.0, 1.0], 1), (1303, [0.5, 0.5], 1)]


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, hard_negatives.mine(df, **kw).collect()))


def test_mine(spark):
    rows = rows_of(1)
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 200
    assert {1200, 1300} <= {r[0] for r in got}
    assert any(r[0] == -100 for r in mined(spark, [*rows, (-101, rows[8][1], -1)]))


def test_blocks_of_any_size_agree(spark):
    rows = rows_of(2, n=500)
    assert mined(spark, rows, block_bytes=500) == brute(rows)


def test_best_merges_in_any_order():
    rng = np.random.default_rng(5)
    slot, score, ids = rng.integers(0, 9, 3000), rng.integers(0, 20, 3000), rng.permutation(3000)
    best = hard_negatives.Best(9, 4)
    best.limit = 100
    for at in range(0, 3000, 7):
        best.add(slot[at : at + 7], score[at : at + 7].astype(float), ids[at : at + 7])
    want = [(s, -t, i) for s in range(9) for t, i in sorted((-t, i) for u, t, i in zip(slot.tolist(), score.tolist(), ids.tolist()) if u == s)[:4]]
    assert list(zip(*(x.tolist() for x in best.merged()))) == want and (best.floor <= 20).all() and (best.floor > 18).all()


def test_products_beyond_doubles(spark):
    rng = np.random.default_rng(3)
    big = [(i, (rng.integers(-(1 << 20), 1 << 20, 4) / 1.0).tolist(), int(lab)) for i, lab in enumerate(rng.integers(0, 2, 120))]
    assert mined(spark, big) == brute(big) and max(abs(r[4]) for r in brute(big)) > 1 << 53
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, [1e200], 0), (1, [1e200], 0)])


def test_first_k_of_ties():
    s = np.array([[1.0, 3.0, 3.0, 3.0, 0.0], [0.0, 0.0, 0.0, 0.0, 0.0]])
    ok = np.array([[True, False, True, True, True], [False, True, False, False, False]])
    assert [x.tolist() for x in hard_negatives.first_k(s, ok, 2)] == [[0, 0, 1], [2, 3, 1]]


def test_share_is_exact():
    scores = [0, 1, 33, -7, 10**15 + 7, 9 * 10**18]
    for p in (30, 90):
        assert hard_negatives.share(np.array(scores), p, False).tolist() == [p * s // 100 for s in scores]
        assert hard_negatives.share(np.array(scores), p, True).tolist() == [-(-p * s // 100) for s in scores]


def test_nothing_to_mine(spark):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert mined(spark, []) == [] and mined(spark, [(100, [1.0], 0)]) == [] and mined(spark, [(101, [1.0], 0), (102, [1.0], 1)]) == []
    df = spark.createDataFrame([(100, [1.0], 0), (3, [1.0], 0), (4, [0.5], 1)], "vec_id long, embedding array<float>, label int")
    got = hard_negatives.mine(df, is_anchor=F.col("vec_id") == 3, label=F.lit(1) - F.col("label"))
    assert got.columns == columns and [tuple(r) for r in got.collect()] == [(3, 100, 1, 4, 65536, 32768)]
