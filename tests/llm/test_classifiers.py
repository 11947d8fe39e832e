import random
import zlib

import pytest

from pitchline.llm import compression_quality as q
from pitchline.llm import queries, toxicity_fm as t

SF = "/root/testdata/sf0.01"


def accuracy(spark, query, SF, column, folds, fold, threshold):
    rows = query(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = all_ = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        if r.held_out and labels.get(r.doc_id) is not None:
            all_ += 1
            good += r.predicted == labels[r.doc_id]
    return good / all_


def test_quality_on_held_out(spark):
    assert accuracy(spark, queries.op6_compression_quality, SF, "quality", 5, 0, 0.3) > 0.96


def test_toxicity_on_held_out(spark):
    assert accuracy(spark, queries.op2_toxicity_fm, SF.replace("0.01", "0.1"), "toxic", 3, 1, 0.7) > 0.96


def test_pairs_are_learned():
    """Neither word alone is toxic, only both in one window: additive weights can't tell."""
    rng = random.Random(1)
    filler = [f"f{i}" for i in range(300)]
    rows = []
    for i in range(3000):
        ws = [rng.choice(filler) for _ in range(20)]
        kind = i % 4
        if kind & 1:
            ws[rng.randrange(10)] = "insult"
        if kind & 2:
            ws[10 + rng.randrange(10)] = "group"
        rows.append((" ".join(ws), int(kind == 3)))
    terms, linear, factors, bias = t.fit_machine(rows[:2000], epochs=30, sharper=0)
    s = t.Scorer(t.Model(terms, linear, factors, bias, (1.0, 0.0)))
    right = sum((s.logit(x) > 0) == bool(y) for x, y in rows[2000:])
    assert right / 1000 > 0.95
    i, g = (terms.tolist().index(t.hashed(w)) for w in ("insult", "group"))
    assert factors[i] @ factors[g] > 0


@pytest.mark.parametrize("classify,column", [(q.classify, "quality"), (t.classify, "toxic")])
def test_edge_cases(spark, classify, column):
    docs = spark.createDataFrame(
        [(1, None, "x", 0.5), (2, "", "x", 0.1), (2, "", "x", 0.1), (None, "word " * 9, "x", 0.0), (4, "a " * 40_000, "x", 0.2), (5, "b c d", "x", 0.3),
         (6, "b c d e", "x", 0.3)], "doc_id long, text string, score string, label double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int, text string")
    assert {r.score for r in classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 1, "z") for i in (1, 2, 4, 5, 6)], none.schema)
    assert all(r.score > 0.99 for r in classify(docs, one).collect())
    two = spark.createDataFrame([(1, 1, 0, "z"), (2, 0, 1, "z"), (2, 0, 1, "z"), (4, 0, 0, "z"), (5, 1, 1, "z"), (6, None, None, "z"), (None, 1, 1, "z")], none.schema)
    assert len(classify(docs, two).collect()) == 7
    assert classify(docs.limit(0), two).collect() == []


@pytest.mark.parametrize("module,column,good", [(t, "toxic", 0), (q, "quality", 1)])
def test_whole_texts_are_learned(spark, module, column, good):
    """What tells the classes apart stands behind the first 40,000 characters of every text."""
    rng = random.Random(5)
    filler = [f"f{i}" for i in range(300)]
    tell = {v: [f"{'bright' if v == good else 'gloomy'}{i}" for i in range(40)] for v in (0, 1)}
    docs, labels = [], []
    for i in range(120):
        head = " ".join(rng.choice(filler) for _ in range(11_000))
        docs.append((i, head + "\n" + "\n".join(" ".join(rng.choice(tell[i % 2]) for _ in range(12)) for _ in range(60))))
        labels.append((i, i % 2))
    assert min(len(x) for _, x in docs) > 40_000
    rows = module.classify(spark.createDataFrame(docs, "doc_id long, text string").repartition(8),
                           spark.createDataFrame(labels, f"doc_id long, {column} int"), threshold=0.5).collect()
    assert sum(r.predicted == r.doc_id % 2 for r in rows if r.held_out) > 0.9 * sum(r.held_out for r in rows)


def test_pairs_of_equally_frequent_words():
    """Both words stand in every text, in one window of the toxic and in different windows of the clean ones."""
    rng = random.Random(6)
    filler = [f"f{i}" for i in range(300)]
    rows = []
    for i in range(3000):
        ws = [rng.choice(filler) for _ in range(160)]
        a = rng.randrange(40, 60)
        ws[a] = "insult"
        ws[a + 1 + rng.randrange(6) if i % 2 else a + 80] = "group"
        rows.append((" ".join(ws), i % 2))
    model = t.Model(*t.fit_machine(rows[:2000]), (1.0, 0.0))
    s = t.Scorer(model)
    z = [s.logit(x) for x, _ in rows[2000:]]
    level = sorted(z)[500]
    assert sum((v > level) == bool(y) for v, (_, y) in zip(z, rows[2000:])) / 1000 > 0.9


def test_logits_equal_the_double_sum_over_pairs():
    import numpy as np

    from pitchline.llm import toxicity_fm as t

    rng = np.random.default_rng(4)
    linear, factors, bias = rng.normal(size=40), rng.normal(size=(40, t.FACTORS)), 0.3
    some = [np.sort(rng.choice(40, size=n, replace=False)) for n in (1, 2, 7, 25, 40)]
    window = np.repeat([0, 3, 4, 9, 11], [len(x) for x in some])
    got = t.logits(window, np.concatenate(some), linear, factors, bias)
    want = [bias + sum(linear[i] for i in x) + sum(factors[i] @ factors[j] for a, i in enumerate(x) for j in x[a + 1 :]) for x in some]
    assert np.allclose(got, want, rtol=1e-12, atol=1e-12)
    assert len(t.logits(window[:0], window[:0], linear, factors, bias)) == 0


def test_a_documents_score_is_its_largest_window():
    """Scorer against windows and terms put together by definition."""
    import random as r

    import numpy as np

    from pitchline.llm import toxicity_fm as t

    rng, nrng = r.Random(5), np.random.default_rng(5)
    vocabulary = [f"word{i}" for i in range(30)]
    terms = np.array(sorted({x for w in vocabulary[:12] for x in t.terms_of(w)}), np.int64)
    model = t.Model(terms, nrng.normal(size=len(terms)), nrng.normal(size=(len(terms), t.FACTORS)) * 0.3, -0.5, (1.0, 0.0))
    scorer = t.Scorer(model)
    place = {int(x): i for i, x in enumerate(terms)}
    for n in (0, 1, 15, 16, 17, 33, 70, 200):
        text = " ".join(rng.choice(vocabulary) for _ in range(n))
        ws = t.words(text)
        best = model.bias
        for start in range(0, max(len(ws) - t.HALF, 1), t.HALF):
            rows = sorted({place[x] for w in ws[start : start + 2 * t.HALF] for x in t.terms_of(w) if x in place})
            z = model.bias + sum(model.linear[i] for i in rows) + sum(model.factors[i] @ model.factors[j] for a, i in enumerate(rows) for j in rows[a + 1 :])
            best = max(best, z)
        assert abs(scorer.logit(text) - best) < 1e-9, n


def test_features_equal_one_shot_compression():
    import random as r

    import zstandard

    from pitchline.llm import compression_quality as c

    rng = r.Random(6)
    good, bad = (" ".join(rng.choice(words) for _ in range(20_000)).encode() for words in (["alpha", "beta", "gamma"], ["junk", "spam", "buy"]))
    compressors = c.Compressors(good[-50_000:], bad[-50_000:])

    def size(block, dictionary):
        kw = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        one = zstandard.ZstdCompressor(level=c.LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False, **kw)
        return len(one.compress(block))

    for text in (b"", b"x", good[:700], bad[:5000], (good[:300] + bad[:300]) * 4):
        blocks = [text[i : i + c.BLOCK] for i in range(0, len(text), c.BLOCK)]
        sizes = [sum(size(b, d) for b in blocks) for d in (good[-50_000:], bad[-50_000:], None)]
        want = ((sizes[1] - sizes[0]) / len(text), sizes[2] / len(text)) if text else (0.0, 0.0)
        assert compressors.features(text) == want


def test_rows_of_words_are_those_of_their_terms(monkeypatch):
    """Equal to the definition; words that begin alike share the hashes of their heads."""
    import numpy as np

    rng = random.Random(9)
    vocabulary = ["", "a", "abc", "abéd", "abcd", "abcde", "abcdef", "ééééééé", "\ud800lone",
                  *("prefix" + "".join(rng.choice("abcé日") for _ in range(8)) for _ in range(300))]
    chosen = sorted({x for w in vocabulary for x in t.terms_of(w)})
    terms = np.array(sorted(rng.sample(chosen, len(chosen) // 2)), np.int64)
    place, asked = {int(x): i for i, x in enumerate(terms)}, []
    hashed = t.hashed
    rows = t.Rows(terms)
    for _ in range(2):
        for n in (0, 1, 500, 500):
            ws = [rng.choice(vocabulary) for _ in range(n)]
            want = sorted((i, place[x]) for i, w in enumerate(ws) for x in t.terms_of(w) if x in place)
            at, row = rows.of(ws)
            assert sorted(zip(at.tolist(), row.tolist())) == want
        rows.forget()
    monkeypatch.setattr(t, "hashed", lambda term: asked.append(term) or hashed(term))
    rows.of(vocabulary[-300:])
    assert len(asked) < 320  # four for each word before
