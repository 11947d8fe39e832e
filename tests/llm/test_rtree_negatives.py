import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchline.llm import rtree_negatives as r


def brute(rows, positives=5, negatives=10, low=30, high=90):
    """The definition, over all pairs of rows (id, label, vector) and an anchor at every tenth id."""
    by_id = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        by_id.setdefault(i, []).append((label, v))
    usable = {i: min(some) for i, some in by_id.items()}
    whole = {i: (label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, (label, v) in usable.items()}
    out = []
    for a, (label, q) in whole.items():
        if a % 10:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, v)), i) for i, (_, v) in whole.items() if i != a and len(v) == len(q))
        for ps, p in [(min(-s, 2**63 - 1), i) for s, i in scores if whole[i][0] == label][:positives]:
            some = [(-s, i) for s, i in scores if whole[i][0] != label and low * ps <= -100 * s <= high * ps][:negatives]
            out += [(a, p, n, i, ps, s) for n, (s, i) in enumerate(some, 1)]
    return sorted(out)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(r, "LEAF", 4)
    monkeypatch.setattr(r, "FAN", 3)
    monkeypatch.setattr(r, "BLOCK_VALUES", 160)
    monkeypatch.setattr(r, "LOT", 5)
    monkeypatch.setattr(r, "STEP", 3)


def test_leaves_hold_every_row_once_and_boxes_bound():
    rng = np.random.default_rng(1)
    for m, d, leaf in [(0, 3, 4), (1, 3, 4), (100, 2, 8), (333, 5, 16), (64, 1, 4), (50, 0, 4)]:
        x = rng.normal(size=(m, d))
        order = r.str_order(x, leaf)
        assert sorted(order.tolist()) == list(range(m))
    x = np.floor(rng.normal(size=(500, 2)) * 100)
    x = x[r.str_order(x, 16)]
    tree = r.Tree(x, np.arange(500), 16, 4)
    assert len(tree.levels[-1][0]) == 1
    sides = tree.levels[0][1] - tree.levels[0][0]
    assert sides.prod(1).mean() < 0.1 * np.prod(x.max(0) - x.min(0))  # tiles, not a random share
    for q in rng.normal(size=(20, 2)):
        for level, step in zip(tree.levels, (16, 64, 256, 1024)):
            up, down = r.bounds(q[None], *level)
            for n in range(len(level[0])):
                scores = x[n * step : (n + 1) * step] @ q
                assert down[0, n] - 1e-9 <= scores.min() and scores.max() <= up[0, n] + 1e-9


def test_search_prunes_and_is_exact():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 3)) * 300
    x = np.floor(np.concatenate([c + rng.normal(size=(64, 3)) * 5 for c in centres]))
    order = r.str_order(x, 16)
    ids = rng.permutation(len(x))
    x, ids = x[order], ids[order]
    tree, opened = r.Tree(x, ids, 16, 4), 0
    for q in x[::97]:
        both = [r.bounds(q[None], *level) for level in tree.levels]
        scores = x @ q
        top = float(scores.max())
        wanted = [r.Wanted(7), r.Wanted(10, -(-3 * top // 10), 9 * top // 10), r.Wanted(3, 2 * top, 3 * top)]
        opened += tree.search(q, [b[0][0].tolist() for b in both], [b[1][0].tolist() for b in both], wanted)
        for w, (k, floor, cap) in zip(wanted, [(7, -np.inf, np.inf), (10, -(-3 * top // 10), 9 * top // 10), (3, 2 * top, 3 * top)]):
            assert w.best == sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if floor <= s <= cap)[:k]
    assert opened < 0.6 * len(x[::97]) * len(tree.levels[0][0])


def vectors(seed, n, d=4, labels=3):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(labels) if rng.random() < 0.6 else 0, [round(rng.gauss(0, 1), 2) for _ in range(d)]) for i in range(n)]
    rows += [(n + i, rows[i % 7][1], rows[i % 7][2]) for i in range(60)]  # copies: ties
    return rows


def found(spark, rows, **kw):
    table = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, label int, embedding array<float>, rank int")
    return sorted(map(tuple, r.mine(table, F.col("vec_id") % 10 == 0, **kw).collect()))


def test_equals_brute_force(spark, small):
    rows = vectors(3, 240)
    assert len(brute(rows)) > 300
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, positives=2, negatives=3, low=10, high=60) == brute(rows, 2, 3, 10, 60)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [*vectors(4, 60), (1000, None, [1.0] * 4), (1010, 1, None), (1020, 1, [1.0, None, 1.0, 1.0]), (1030, 1, [nan] * 4), (1040, 1, [inf] * 4),
            (None, 1, [1.0] * 4), (1050, 1, [0.5, 0.5]), (1051, 1, [0.5, 0.4]), (1052, 2, [0.4, 0.4]), (1060, 1, []), (1061, 1, []), (1062, 2, []),
            (10, 2, [9.0] * 4), (10, 2, [9.0] * 4), (1070, 0, [0.0] * 4), (-10, 0, [-1.0] * 4)]
    assert found(spark, rows) == brute(rows)
    big = [(i, i % 2, [float(np.float32(3e16 * (i + 1))), float(np.float32(-1e14 * i))]) for i in range(12)]
    assert found(spark, big) == brute(big) == []  # nothing lies in the window of the longest long
    exact = [(i, i % 2, [float(np.float32(3e4 * (i + 1) + i)), float(np.float32(-1e4 * i)), 2.0 ** 16]) for i in range(40)]
    assert found(spark, exact) == brute(exact)
    assert found(spark, []) == [] == found(spark, [(10, 1, [1.0])])
