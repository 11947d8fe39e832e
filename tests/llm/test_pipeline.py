import sys
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as p
from pitchline.llm import compression_quality, toxicity_fm

sys.path.insert(0, str(Path(__file__).parent))
from test_golay_simhash import brute_components, brute_fingerprint  # noqa: E402
from test_repeat_tree import brute as brute_repeats  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = docs
    good = {r.doc_id for r in compression_quality.classify(kept, labels).collect() if r.predicted}
    kept = kept.where(kept.doc_id.isin(sorted(good)))
    bad = {r.doc_id for r in toxicity_fm.classify(kept, labels).collect() if r.predicted}
    left = sorted(good - bad)
    comp = brute_components({d: brute_fingerprint(texts[d]) for d in left})
    left = [d for d in left if comp[d] == d]
    cut = brute_repeats([(d, texts[d]) for d in left])
    got = p.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(left)

    stage = docs.where(docs.doc_id.isin(left))
    rest = p.substring_dedup(spark, stage, SF)
    assert rest.columns == docs.columns and rest.dtypes == docs.dtypes
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rest.collect():
        n, gone, _, _ = cut[r.doc_id]
        assert 0 <= len(r.text.encode()) - (n - gone) <= 6 * (gone > 0) * cut[r.doc_id][2]
        assert r.n_chars == len(r.text)
        mine = [x for x in got if x.doc_id == r.doc_id]
        assert sum(x.length for x in mine) == len(tok.encode(r.text, add_special_tokens=False).ids) + 1


def test_rows_are_kept_for_their_texts_not_their_ids(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    words = [" ".join(f"{w}{i * i}" for i in range(60)) for w in ("one", "two", "three", "four")]
    rows = [(1, words[0]), (1, words[0]), (1, words[1]), (None, words[2]), (None, words[2]), (None, words[3]), (2, words[0])]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], schema)
    left = p.simhash_dedup(spark, docs, SF)
    assert left.columns == docs.columns
    want = [(1, words[0]), (1, words[1]), (None, words[2]), (None, words[3])]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)
    cut = p.substring_dedup(spark, left, SF)
    assert cut.columns == docs.columns and sorted(((r.doc_id, r.text) for r in cut.collect()), key=str) == sorted(want, key=str)


def test_clashing_columns_are_left_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: p.F.lit(1) for c in ("key", "id", "label", "score", "fingerprint", "kept")})
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == p.COLUMNS and out.count() > 0


def test_stages_take_empty_tables_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (1, "a b", "en", None, 3), (None, "", None, "s", 0), (2, "x" * 300_000, "en", "s", 3)], docs.schema)
    for rows in (docs.limit(0), odd):
        now = rows
        for name, stage in p.STAGES:
            now = stage(spark, now, SF)
            if name != "packing":
                assert now.columns == docs.columns
            now.collect()
