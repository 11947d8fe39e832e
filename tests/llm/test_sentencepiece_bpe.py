import random

import numpy as np
import public_tokenizers
import sentencepiece

from pitchline.llm import sentencepiece_bpe as s

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "   a", "a  ", "a   b    c", "▁", "a▁b ▁", "\0 a", "<s> </s> <unk> <0x41>", "日本語 テスト 🙂🙃",
       "é" * 50, "a\nb\t c\r\n", "﻿x", "x" * 20_000, "word " * 20_000, "  　", "ABCabc123 1234567", "á", "  \n  "]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_agenda_equals_library():
    rng = random.Random(5)
    alphabet = list("abcdefghij  .,\n\t") + ["the", "ing", "é", "ß", "日", "▁", "🙂", "  ", "\0", "1", "́"]
    texts = [t or "" for t in ODD] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    codec, lib = s.Codec(PATH), library()
    assert codec.chunked
    want = lib.encode(texts, add_bos=True, add_eos=True)
    for text, ids, (mine, back) in zip(texts, want, codec.round_trip(texts)):
        assert np.frombuffer(mine, "<u4").tolist() == ids, text
        assert back.decode() == lib.decode(ids) == codec.decode(ids)
    assert all(codec.library_agrees(texts)) and not codec.unchecked
    off = s.Codec(PATH)
    del off.rank["▁the"], off.id["▁the"]
    off.round_trip(["of the", "of"])
    assert off.library_agrees(["of the", "of"]) == [False, True]
    whole = s.Codec(PATH)
    whole.chunked = False
    short = [t for t in texts if len(t) < 1000]
    assert whole.round_trip(short) == codec.round_trip(short)


def test_decode_of_any_ids():
    rng = random.Random(6)
    codec, lib = s.Codec(PATH), library()
    for _ in range(500):
        ids = [rng.randrange(259, 32_000) for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == lib.decode(ids)


def test_query_columns(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(ODD)] + [(None, "a", 7), (1, "", 7)], "doc_id long, text string, ids int")
    rows = s.encode(docs, PATH).collect()
    assert len(rows) == len(ODD) + 2 and all(r.matches_library for r in rows)
    lib = library()
    for r in rows:
        if r.doc_id is not None:
            text = ODD[r.doc_id] or ""
            ids = lib.encode(text, add_bos=True, add_eos=True)
            assert bytes(r.ids) == np.array(ids, "<u4").tobytes() and r.decoded == lib.decode(ids)
    assert s.encode(docs.limit(0), PATH).collect() == []


def test_new_atoms_of_a_lot_are_merged_side_by_side(monkeypatch):
    """Equal to one agenda an atom, whatever the lots; only long atoms and odd characters still get one of their own."""
    rng = random.Random(8)
    alphabet = list("aabcdeeefghiinoorstt") + ["th", "ing", "é", "ß", "日", "▁", "  "]
    texts = [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["\0🙃a", ""]
    codec, merged = s.Codec(PATH), []
    merge = codec.merge
    monkeypatch.setattr(codec, "merge", lambda text: merged.append(text) or merge(text))
    want = codec.round_trip(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids, _ in want] == library().encode(texts, add_bos=True, add_eos=True)
    assert all(codec.library_agrees(texts))
    assert len(codec.atoms) > 1000 and len(merged) < len(codec.atoms) / 2
    assert all(len(a) > s.SHORT or any(p not in codec.id for p in merge(a)) for a in merged)
    for a, ids in codec.atoms.items():
        assert ids == codec._atom(a), a
    for name in ("LOT", "SHORT"):
        monkeypatch.setattr(s, name, 1)
        assert s.Codec(PATH).round_trip(texts) == want
