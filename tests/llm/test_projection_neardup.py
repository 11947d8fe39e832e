import numpy as np
import pytest

from pitchline.llm import projection_neardup as p
from pitchline.llm import queries


def brute(rows, threshold=0.9):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: set() for i in good}
    for a in good:
        for b in good:
            if a != b and len(good[a]) == len(good[b]):
                c = good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b])
                if c >= threshold:
                    links[a].add(b)
    comp = {i: i for i, _ in rows if i is not None}
    for i in sorted(good):
        stack = [i]
        while stack:
            j = stack.pop()
            for k in links[j]:
                if comp[k] > comp[i]:
                    comp[k] = comp[i]
                    stack.append(k)
    return {i: (len(links.get(i, ())), comp[i], comp[i] == i) for i in comp}


def answer(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect() if r.vec_id is not None}


def corpus():
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for size in (1, 1, 2, 3, 40, 7, 150):
        base = rng.standard_normal(32)
        for _ in range(size):
            v = base + rng.standard_normal(32) * rng.choice([0.02, 0.2, 0.3])
            rows.append((i * 7 % 1009, [float(np.float32(x)) for x in v]))
            i += 1
    rows += [(2000, None), (2001, []), (2002, [0.0] * 32), (2003, [1.0] * 31 + [None]), (2004, [1.0] * 31 + [float("nan")]),
             (2005, [1.0] * 31 + [float("inf")]), (2006, rows[5][1]), (2007, rows[5][1]), (2008, [x * 2 for x in rows[5][1]]), (2009, [1.0, 2.0]), (2010, [1.0, 2.1])]
    return rows


@pytest.mark.parametrize("block", [4096, 60])
def test_matches_brute_force(spark, block):
    rows = corpus()
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows] + [(None, rows[0][1], 1.0), (2006, rows[5][1], 2.0)],
                               "vec_id long, embedding array<float>, token double")
    got = p.neardup(df, block=block)
    assert got.count() == len(rows) + 2
    assert answer(got) == brute(rows)


def test_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert answer(queries.op7_projection_neardup(spark, "/root/testdata/sf0.01")) == brute(rows)


def test_empty(spark):
    assert p.neardup(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_calibration_holds_its_recall():
    c = p.calibrated(512, 64, 0.9, p.DEPTH, p.WIDTH, 0.999)
    rng = np.random.default_rng(8)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.standard_normal(x.shape) * 0.055
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = (x * y).sum(1) >= 0.9
    a = p.directions(512, 64)
    hits = p._collisions(*p.postings(x, a, p.DEPTH), *p.postings(y, a, p.DEPTH), p.WIDTH).sum(1)
    assert c >= 2 and (hits[near] >= c).mean() >= 0.998
