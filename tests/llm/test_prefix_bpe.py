import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pitchline.llm import prefix_bpe as b
from pitchline.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " ", "   a", "a  ", "<|endoftext|> z", "日本語 テスト 🙂🙃", "it's we'LL 're", "a\nb\t c\r\n\x1c\x85　", "՘࢏ \U00011de0\U00011de1 1",
       "a" * 3000, "ab" * 2000, " " * 3000, "the" * 2000, "é" * 500]


def random_text(rng, size):
    alphabet = [*"abcdefghijklmnop  .,'\n\t", "the", "ing", "'re", "é", "日", "🙂", "  ", "1", "12", "՘", "\U00011de0", "aaaa", "!!!!"]
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, size)))


@pytest.fixture(scope="module")
def codec():
    return b.Codec(PATH)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=b.load_ranks(PATH), special_tokens={})


def test_equals_library(codec, library):
    rng = random.Random(3)
    for text in [t or "" for t in ODD] + [random_text(rng, 60) for _ in range(4000)] + ["".join(rng.choice("abcdef") for _ in range(20_000))]:
        packed = codec.packed(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text), text[:80]
        assert codec.decoded(packed) == text.encode()


def test_every_prefix_has_its_last_token(codec, library):
    rng = random.Random(4)
    for _ in range(200):
        data = bytes(rng.choice(b"abcdeinrst ") for _ in range(30))
        table = codec.words.prefix_tokens(data)
        for n in range(1, len(data) + 1):
            assert codec.words.ids(data[:n], table) == library._core_bpe.encode_single_piece(data[:n])
        assert codec.words.prefix_tokens(data, table[:11]) == table  # an append goes on where the table ends


def test_small_vocabulary_equals_plain_merging():
    """All tokens over two letters up to some length in random order of ranks, where merges may open
    pairs that come before them, against merging by definition."""
    rng = random.Random(5)
    for _ in range(60):
        some = {bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(1, 9))}
        longer = sorted(some)
        rng.shuffle(longer)
        ranks = {bytes([i]): i for i in range(256)} | {t: 256 + i for i, t in enumerate(longer)}
        words = b.Vocabulary(ranks)
        for _ in range(40):
            data = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 14)))
            parts = [data[i : i + 1] for i in range(len(data))]
            while True:
                ranked = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts[:-1], parts[1:])) if x + y in ranks]
                if not ranked:
                    break
                _, i = min(ranked)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            want = [ranks[data]] if data in ranks else [ranks[p] for p in parts]
            assert words.ids(data, words.prefix_tokens(data)) == want, (longer, data)


def test_edits_equal_encoding_anew(codec):
    rng = random.Random(6)
    for _ in range(2000):
        text, insert = random_text(rng, 80), random_text(rng, 6)
        start = rng.randint(0, len(text))
        stop = rng.randint(start, len(text))
        if rng.random() < 0.2:
            start = stop = len(text)
        new, ids, table, _ = codec.reencoded(text, codec.packed(text), codec.table(text), start, stop, insert)
        assert new == text[:start] + insert + text[stop:]
        assert ids == codec.packed(new) and np.array_equal(table, codec.table(new))
    long = "".join(rng.choice("abcdef") for _ in range(50_000))  # one match
    new, ids, table, worked = codec.reencoded(long, codec.packed(long), codec.table(long), 20_000, 20_001, "zz")
    assert worked < 1000 and ids == codec.packed(new) and np.array_equal(table, codec.table(new))


def test_operator_and_edits_on_tables(spark, library):
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(None, "a", 7), (1, "", 7), (5, "a b", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = b.encode(docs, PATH, prefixes=True).collect()
    assert len(found) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = [(i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, _ in rows]
    assert sorted([(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in found], key=key) == sorted(want, key=key)
    assert b.encode(docs.limit(0), PATH).collect() == []
    codec = b.Codec(PATH)
    edits = [(1, "one two", "one two", None, None, " three"), (2, "one two", "one two", 4, 5, None), (3, None, "", -5, 99, "x"), (4, "abc def", "abc def", 5, 2, "q")]
    table = spark.createDataFrame([(i, t, codec.packed(u), codec.table(u).tobytes(), s, e, n) for i, t, u, s, e, n in edits],
                                  "doc_id long, text string, ids binary, prefixes binary, start long, stop long, insert string")
    got = {r.doc_id: r for r in b.reencode(table, PATH).collect()}
    for i, text in {1: "one two three", 2: "one wo", 3: "x", 4: "abc dqef"}.items():
        assert got[i].text == text and bytes(got[i].ids) == codec.packed(text) and bytes(got[i].prefixes) == codec.table(text).tobytes()


def test_query_on_whole_table(spark, library):
    import duckdb

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op11_prefix_bpe"](spark, folder).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{folder}/documents.parquet'").fetchall())
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
