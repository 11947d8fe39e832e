import random

import numpy as np
import xxhash

from pitchline.llm import golay_simhash as g


def brute_fingerprint(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    comp = {d: d for d in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 4 and comp[b] < comp[a]:
                    comp[a] = comp[b]
                    changed = True
    return comp


def test_keys_meet_within_four_bits():
    rng = random.Random(1)
    for _ in range(3000):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        row, key = g.fuzzy_keys(np.array([x, y], np.uint64))
        assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


def test_every_word_has_one_or_six_codewords():
    words = np.arange(0, 1 << 23, 997, dtype=np.int64)
    _, mask = g.segment_keys(words)
    assert set(mask.sum(1).tolist()) == {1, 6}


def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(300)]
        for _ in range(5):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((i, " ".join(t)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \t\n"), (i + 3, "ÀB c"), (i + 4, "Àb C"), (i + 5, "one"),
             (i + 6, "a b c d e f"), (i + 7, "x " * 5000)]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(a, b, "z") for a, b in rows], "doc_id long, text string, fp string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in g.simhash_components(docs).collect()}
    fps = {d: brute_fingerprint(t) for d, t in rows}
    comp = brute_components(fps)
    assert got == {d: (f"{fps[d]:016x}", comp[d]) for d in fps}
    small = g.simhash_components(docs, block=2).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in small} == got


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert g.simhash_components(empty).collect() == []
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b")], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in g.simhash_components(twice).collect())
    assert got == [("1", "1"), ("1", "1"), ("None", "None")]
