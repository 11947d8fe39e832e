import hashlib
import random
import tracemalloc
import types
import weakref

import numpy as np
import pyarrow as pa

from pitchline.llm import repeat_tree as r
from pitchline.llm.common import process_cache


def brute(rows, n=100):
    first = {}
    for d, t in sorted((d, (t or "").encode()) for d, t in rows):
        for i in range(len(t) - n + 1):
            first.setdefault(t[i:i + n], (d, i))
    out = {}
    for d, t in rows:
        t = (t or "").encode()
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if first[t[i:i + n]] != (d, i):
                gone[i:i + n] = b"\1" * n
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[d] = (len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    syl = ["the", "on", "re", "é", "ß", "ing", "at", "日"]

    def prose(n):
        return " ".join("".join(rng.choice(syl) for _ in range(rng.randint(1, 4))) for _ in range(n))

    passages = [prose(rng.randint(18, 60)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else prose(rng.randint(3, 80)))
            if rng.random() < 0.2:
                parts.append(parts[-1][rng.randint(0, 20):])
        rows.append((i * 3 % 61, " ".join(parts)))
    rows += [(100, None), (101, ""), (102, "x" * 350), (103, "ab" * 200), (104, "x" * 99), (105, "x" * 100),
             (106, rows[3][1]), (107, rows[3][1]), (108, "é" * 120), (109, "abc" * 5000), (110, "\0" * 150 + "é" * 51)]
    return rows


def answer(df):
    return {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, hashlib.sha256(bytes(x.kept)).hexdigest()) for x in df.collect()}


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        docs = spark.createDataFrame([(t, d, 1) for d, t in rows], "text string, doc_id long, low int")
        assert answer(r.dedup(docs)) == brute(rows)


def test_hot_anchor_path_gives_the_same(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(r.dedup(docs, hot=2)) == brute(rows)


def test_repeated_rows_and_null_ids_are_documents_of_their_own(spark):
    rng = random.Random(9)
    text, other = "".join(rng.choice("abcdefgh") for _ in range(409)), "y" + "z" * 20
    rows = [(1, text), (1, text), (None, text + "!"), (1, other), (0, "before"), (None, None)]
    docs = spark.createDataFrame([(*x, 7) for x in rows], "doc_id long, text string, key int")
    got = sorted(((x.doc_id, x.n_bytes, x.n_removed, bytes(x.kept).decode()) for x in r.dedup(docs).collect()), key=str)
    assert got == sorted([(1, 409, 0, text), (1, 409, 409, ""), (None, 410, 409, "!"), (1, 21, 0, other), (0, 6, 0, "before"), (None, 0, 0, "")], key=str)
    kept = r.dedup(docs, keep=["key"])
    assert kept.columns == ["doc_id", "key", "n_bytes", "n_removed", "n_spans", "kept"] and {x.key for x in kept.collect()} == {7}


def test_empty_table(spark):
    assert r.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_text_keeps_whole_characters(spark):
    shared = "".join(chr(0xC0 + i) for i in range(60))
    docs = spark.createDataFrame([(1, "é" + shared), (2, "z©" + shared), (3, None)], "doc_id long, text string")
    raw = {x.doc_id: bytes(x.kept) for x in r.dedup(docs).collect()}
    assert raw[2] == b"z\xc2"
    got = {x.doc_id: bytes(x.kept).decode() for x in r.dedup(docs, whole_characters=True).collect()}
    assert got == {1: "é" + shared, 2: "z©", 3: ""}


def test_maximal_repeats_have_all_occurrences():
    import numpy as np
    strings = [b"1" + b"abcdefgh" + b"2", b"3" + b"abcdefgh" + b"4", b"5" + b"abcdefgh" + b"2"]
    got = {(n, tuple(sorted(p))) for n, p in r.maximal_repeats(strings, np.zeros(3, np.int64), 4)}
    assert got == {(8, ((0, 1), (1, 1), (2, 1))), (9, ((0, 1), (2, 1)))}


def peak(run):
    """MB that numpy and Python held at once."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_anchors_does_not_follow_the_batch():
    run = r.anchors(types.SimpleNamespace(mapInArrow=lambda run, _: run), 100, 20)

    def batch(n):
        texts = [random.Random(i).randbytes(1000).hex() for i in range(n)]
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(range(n), pa.int64()), "text": texts})

    small, large = batch(4_000), batch(16_000)
    most = peak(lambda: [None for _ in run(iter([small]))])
    assert peak(lambda: [None for _ in run(iter([large]))]) < 1.3 * most


def test_memory_of_suffix_groups():
    strings = [random.Random(i).randbytes(180) for i in range(20_000)]  # 1.6 million windows
    assert peak(lambda: list(r._suffix_groups(strings, np.arange(20_000) // 20, 100))) < 80


def test_a_worker_holds_one_operators_object():
    class Model:
        pass

    first = weakref.ref(process_cache("first", 1, Model))
    assert process_cache("first", 1, Model) is first()
    process_cache("second", 1, lambda: (Model(), first() is None)[1])
    assert first() is None
    assert process_cache("second", 1, Model) is True
