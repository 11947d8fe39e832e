import math
import random
from collections import Counter

from pitchline.llm import stupid_backoff as s


def brute(texts, order=3, a=0.4):
    split = [(t or "").encode().split() for t in texts]
    own = [Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)) for w in split]
    all_ = Counter()
    for c in own:
        all_.update(c)
    total = sum(map(len, split))
    out = []
    for w, mine in zip(split, own):
        log = 0.0
        for i in range(len(w)):
            m = min(order, i + 1)
            for n in range(m, 0, -1):
                g = tuple(w[i - n + 1:i + 1])
                c = all_[g] - mine[g]
                if c > 0:
                    base = all_[g[:-1]] - mine[g[:-1]] if n > 1 else total - len(w)
                    log += math.log(a ** (m - n) * c / base)
                    break
            else:
                log += math.log(a ** m / max(1, total - len(w)))
        out.append((len(w), log))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(1)
    words = ["a", "b", "c", "the", "é", "日本", "x" * 30]
    texts = [" ".join(rng.choice(words + [f"r{rng.randrange(2000)}"]) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    texts += [None, "", " \n", "a", "a b a", texts[0], texts[0], "the " * 20_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, block int")
    for size in (1 << 24, 4000):
        got = {r.doc_id: r for r in s.score(df, block_bytes=size).collect()}
        assert len(got) == len(texts)
        for i, (n, log) in enumerate(brute(texts)):
            assert got[i].n_tokens == n and math.isclose(got[i].log_score, log, rel_tol=1e-9, abs_tol=1e-9)
            assert (got[i].perplexity is None) == (n == 0)


def test_one_document_and_none(spark):
    one = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    r = s.score(one).collect()[0]
    assert r.doc_id is None and math.isclose(r.log_score, math.log(0.4) + math.log(0.16))
    assert s.score(one.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "a b")] * 2, "doc_id long, text string")
    assert all(math.isclose(x.log_score, math.log(0.5)) for x in s.score(twice).collect())
