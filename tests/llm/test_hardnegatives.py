"""Hard negatives against all pairs, and what the tree passes over."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostra.llm import hardnegatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, leaf int"


def plain(rows, positives=5, negatives=10, least=30, most=90, scale=256):
    """All results, by comparing each anchor with every row."""
    usable, widths = {}, defaultdict(int)
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = tuple(math.floor(scale * c) for c in v)
        if max(map(abs, x)) < 2**31 and sum(c * c for c in x) < 2**62 * 0.99:
            usable[(i, label, x)] = None
            widths[len(x)] += 1
    width = min(widths, key=lambda w: (-widths[w], w)) if widths else 0
    usable = [r for r in usable if len(r[2]) == width]
    out = []
    for i, label, x in usable:
        if i % 100:
            continue
        others = sorted(
            (-sum(a * b for a, b in zip(x, y)), j, lab == label) for j, lab, y in usable if j != i
        )
        for p, j, _ in [o for o in others if o[2]][:positives]:
            found = [(n, k) for n, k, same in others if not same and least * -p <= 100 * -n <= most * -p][:negatives]
            out += [(i, j, at, k, -p, -n) for at, (n, k) in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, **how):
    frame = spark.createDataFrame([(*r, "mine", 7) for r in rows], SCHEMA)
    found = hardnegatives.mine(frame, F.col("vec_id") % 100 == 0, **how)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def vectors(n, width, labels=4, seed=0, spread=0.4):
    pick = np.random.default_rng(seed)
    centres = pick.standard_normal((labels * 3, width))
    own = pick.integers(0, len(centres), n)
    points = centres[own] + spread * pick.standard_normal((n, width))
    return [(i, points[i].tolist(), int(own[i] % labels)) for i in range(n)]


@pytest.mark.parametrize("sample", [10_000, 150])
def test_all_results_of_all_pairs(spark, sample):
    rows = vectors(600, 6) + [(10_000 + 100 * k, v, label) for k, (_, v, label) in enumerate(vectors(4, 6, seed=9))]
    want = plain(rows)
    assert len(want) > 200 and mined(spark, rows, sample_rows=sample) == want


def test_odd_rows(spark):
    base = vectors(120, 3, labels=2, seed=4, spread=2.0)
    odd = [
        (200, None, 1), (300, [], 1), (400, [1.0, None, 2.0], 1), (500, [math.nan, 1.0, 1.0], 0), (600, [math.inf, 1.0, 1.0], 0),
        (700, [1.0, 2.0], 0), (800, [1e30, 0.0, 0.0], 0), (None, [1.0, 2.0, 3.0], 0), (900, [1.0, 2.0, 3.0], None),
        (1000, [0.0, 0.0, 0.0], 0), (1001, [5e6, 1.0, -1.0], 1),
    ]
    ties = [(2000 + k, base[5][1], k % 2) for k in range(40)]
    shared = [(0, base[7][1], base[7][2]), (13, base[8][1], 1), (13, base[9][1], 0)]
    repeated = base[:30] * 3
    rows = base + odd + ties + shared + repeated
    want = plain(rows)
    assert want and mined(spark, rows) == want
    # A table of one label has no negatives, one anchor alone no positives.
    assert mined(spark, [(i, v, 1) for i, v, _ in base]) == []
    assert mined(spark, base[:1]) == [] and mined(spark, []) == []
    assert mined(spark, [(i, None, 1) for i in range(5)]) == []


def test_hot_leaf_is_many_groups(spark, monkeypatch):
    monkeypatch.setattr(hardnegatives, "_ROWS", 40)
    monkeypatch.setattr(hardnegatives, "_ANCHORS", 3)
    same = vectors(1, 4)[0][1]
    rows = [(10 * i, same, i % 3) for i in range(250)] + vectors(90, 4, seed=2)
    assert mined(spark, rows) == plain(rows)


def test_the_tree_passes_over_far_clusters():
    """Leaves without rows of a window are not visited where vectors lie in clusters, and none with one is left out."""
    pick = np.random.default_rng(1)
    centres = np.kron(np.eye(8), np.ones(2)) * 400
    x = np.round(centres[pick.integers(0, 8, 4000)] + 20 * pick.standard_normal((4000, 16))).astype(np.int64)
    squares = (x * x).sum(axis=1).astype(float)
    tree = hardnegatives.grow(x[:1000], squares.max() ** 0.5, len(x))
    leaf, ranges = hardnegatives.deal(tree, x.astype(float), squares)
    tree.low = [ranges[i][0] for i in range(len(tree.nodes))]
    tree.high = [ranges[i][1] for i in range(len(tree.nodes))]
    of = np.arange(60)
    scores = x[of] @ x.T
    high = np.sort(scores, axis=1)[:, -200]
    low = np.sort(scores, axis=1)[:, -260]
    rings = [np.sqrt(np.maximum(squares[of] + tree.length**2 - 2.0 * s, 0)) for s in (high, low)]
    windows, leaves = hardnegatives.visit(tree, x[of].astype(float), squares, of, *rings)
    assert len(windows) < 0.5 * len(of) * (leaf.max() + 1)
    visited = set(zip(windows.tolist(), leaves.tolist()))
    for w in of:
        inside = np.flatnonzero((scores[w] >= low[w]) & (scores[w] <= high[w]))
        assert all((w, l) in visited for l in leaf[inside].tolist())


def test_scores_beyond_doubles():
    pick = random.Random(0)
    a = np.array([[pick.randrange(-(2**30), 2**30) for _ in range(2)] for _ in range(20)])
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in a] for p in a]
    assert hardnegatives._scores(a, a).tolist() == want
