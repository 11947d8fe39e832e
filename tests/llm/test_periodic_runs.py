import hashlib
import random
import re
import zlib
from fractions import Fraction

from pitchline.llm import periodic_runs as p
from pitchline.llm.queries import QUERIES


def brute(w, least=6, turns=4):
    """Every run by its definition."""
    found = []
    for q in range(1, len(w) // turns + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            size = i - start + q
            if size >= max(least, turns * q) and not any(w[start : start + size - d] == w[start + d : start + size] for d in range(1, q)):
                found.append((start, size, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    return [x for i, x in enumerate(w) if i not in drop]


def triples(runs):
    return [(r["start"], r["length"], r["period"]) for r in runs]


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(800):
        docs = []
        for _ in range(rng.randint(1, 5)):
            letters = "abc"[: rng.choice([1, 2, 3])]
            w = [rng.choice(letters) for _ in range(rng.randint(0, 12))]
            for _ in range(rng.randint(0, 3)):
                turn = [rng.choice(letters) for _ in range(rng.randint(1, 7))]
                w += (turn * rng.randint(1, 7))[: rng.randint(1, 40)]
            docs.append(w)
        least, turns = rng.choice([(6, 4), (1, 3), (10, 5)])
        runs, collapsed = p._worked([" ".join(w).encode() for w in docs], least, turns)
        for w, r, c in zip(docs, runs, collapsed):
            assert triples(r) == brute(w, least, turns), w
            assert c.decode() == " ".join(kept(w, triples(r)))


def test_odd_texts(spark):
    long = " ".join(["x"] * 150_000 + [f"w{i}" for i in range(50_000)] + ["p", "q", "r"] * 30_000)
    rows = [(1, None, 5), (2, "", 5), (3, " \t\n ", 5), (4, long, 5), (4, "a a a a a a", 5), (None, "a a a a a a", 5), (5, "a a é a\x1ca", 5),
            (6, "a  b\ta b\na b a b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    found = p.periodic_runs(docs).collect()
    assert len(found) == len(rows)
    by = {(r.doc_id, len(r.collapsed)): r for r in found}
    assert [by[i, 0].runs for i in (1, 2, 3)] == [[], [], []]
    whole = next(r for r in found if r.doc_id == 4 and len(r.runs) == 2)
    assert triples(whole.runs) == [(0, 150_000, 1), (200_000, 90_000, 3)]
    assert whole.collapsed == " ".join(["x"] + [f"w{i}" for i in range(50_000)] + ["p", "q", "r"])
    assert triples(by[4, 1].runs) == triples(by[None, 1].runs) == [(0, 6, 1)]
    assert by[5, 9].runs == [] and by[5, 9].collapsed == "a a é a\x1ca"
    assert triples(by[6, 3].runs) == [(0, 8, 2)]
    assert p.periodic_runs(docs.limit(0)).collect() == []


def test_best_run(spark):
    runs = [[(5, 8, 2), (9, 4, 1), (20, 9, 2)], [(3, 13, 3), (30, 13, 3)], []]
    made = spark.createDataFrame([(i, r) for i, r in enumerate(runs)], f"i int, runs {p.RUN}").select("i", p.best_run().alias("b"))
    got = {r.i: r.b and tuple(r.b) for r in made.collect()}
    assert got == {0: (20, 9, 2), 1: (3, 13, 3), 2: None}


def expected(doc_id, text):
    """The query's row for a text, word by word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and words and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g, n = h // 10, len(words)
        a = g % n
        turn = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % turn] for i, w in enumerate(words)]
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(" ".join(kept(words, runs))))


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["a", "b", "c d", "é"]) for _ in range(rng.randint(0, 90)))) for i in range(-20, 300)]
    rows += [(None, "x " * 50), (7, None), (8, ""), (8, " ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(*r) for r in rows), key=str)


def test_query_on_given_texts(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    assert len(got) == len(texts)
    for doc_id, text in texts:
        if len(text or "") < 8000:  # brute force is quadratic
            assert got[doc_id] == expected(doc_id, text)
