import numpy as np
from pyspark.sql import functions as F

from pitchline.llm import permutation_ann as a
from pitchline.llm import queries


def brute(rows, asked, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, float)
    out = {}
    for q in good:
        if asked(q):
            score = sorted((-(good[q] @ v) / (np.linalg.norm(good[q]) * np.linalg.norm(v)), i)
                           for i, v in good.items() if i != q and len(v) == len(good[q]))[:k]
            out[q] = [(i, -s) for s, i in score]
    return out


def answer(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def same(got, want):
    assert {q for q, w in want.items() if w} == set(got)
    for q, g in got.items():
        assert [i for i, _ in g] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in g], [s for _, s in want[q]], atol=1e-12)


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(8)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(9)]  # ties
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [None] + [1.0] * 7), (404, [float("nan")] + [1.0] * 7),
             (405, [float("inf")] + [1.0] * 7), (450, [1.0, 2.0]), (500, [2.0, 1.0])]
    df = spark.createDataFrame([(i, v, 9) for i, v in rows] + [(None, rows[0][1], 9), (7, rows[7][1], 9)], "vec_id long, embedding array<float>, rank int")
    got = answer(a.search(df, F.col("vec_id") % 50 == 0, block_rows=100, query_rows=4))
    same(got, brute(rows, lambda i: i % 50 == 0))


def test_recall_on_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 50 == 0)
    got = answer(a.search(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 50 == 0, least=1, share=a.SHARE))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert set(got) == set(want) and hits / sum(map(len, want.values())) >= 0.9
    same(answer(queries.op3_permutation_ann(spark, "/root/testdata/sf0.01")),
         brute([(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()], lambda i: i % 50 == 0))


def test_empty(spark):
    assert a.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(50, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert a.search(one, F.col("vec_id") % 50 == 0).collect() == []
