"""Registered queries ``opN_<name>``: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm import (
    compression_quality,
    golay_simhash,
    html_host,
    periodic_runs,
    permutation_ann,
    prefix_bpe,
    projection_neardup,
    repeat_tree,
    rtree_negatives,
    sentencepiece_bpe,
    stupid_backoff,
    swap_packing,
    toxicity_fm,
)
from pitchline.llm.common import table


def op1_sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "matches_library")


def op2_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                folds=3, fold=1, threshold=0.7)


def op3_permutation_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = stupid_backoff.score(table(spark, sf_dir, "documents"), order=3, backoff=0.4)
    return rated.select("doc_id", "n_tokens", F.round("log_score", 4).alias("log_score"))


def op5_html_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_host.extract(table(spark, sf_dir, "pages"))


def op6_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                        folds=5, fold=0, threshold=0.3)


def op7_projection_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_neardup.neardup(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op8_repeat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeat_tree.dedup(table(spark, sf_dir, "documents"), length=100)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swap_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             limit=1024, end_id=2)


def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay_simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = prefix_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_rtree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return rtree_negatives.mine(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90, scale=256.0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.planted(table(spark, sf_dir, "documents")), least_length=6, least_turns=4)
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", periodic_runs.best_run()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_sentencepiece_bpe": op1_sentencepiece_bpe,
    "op2_toxicity_fm": op2_toxicity_fm,
    "op3_permutation_ann": op3_permutation_ann,
    "op4_stupid_backoff": op4_stupid_backoff,
    "op5_html_host": op5_html_host,
    "op6_compression_quality": op6_compression_quality,
    "op7_projection_neardup": op7_projection_neardup,
    "op8_repeat_tree": op8_repeat_tree,
    "op9_swap_packing": op9_swap_packing,
    "op10_golay_simhash": op10_golay_simhash,
    "op11_prefix_bpe": op11_prefix_bpe,
    "op12_rtree_negatives": op12_rtree_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE_SQL: dict[str, str] = {
    "op4_stupid_backoff": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        places AS (SELECT doc_id, unnest(ws) AS c, generate_subscripts(ws, 1) AS i FROM split),
        grams AS (
            SELECT doc_id, i, c, lag(c) OVER d AS b, lag(c, 2) OVER d AS a
            FROM places WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
        one AS (SELECT doc_id, c, sum(count(*)) OVER (PARTITION BY c) - count(*) AS n FROM grams GROUP BY doc_id, c),
        two AS (
            SELECT doc_id, b, c, sum(count(*)) OVER (PARTITION BY b, c) - count(*) AS n
            FROM grams WHERE b IS NOT NULL GROUP BY doc_id, b, c),
        three AS (
            SELECT doc_id, a, b, c, sum(count(*)) OVER (PARTITION BY a, b, c) - count(*) AS n
            FROM grams WHERE a IS NOT NULL GROUP BY doc_id, a, b, c),
        rest AS (SELECT doc_id, len(ws) AS size, sum(len(ws)) OVER () - len(ws) AS n FROM split),
        logs AS (
            SELECT g.doc_id, CASE
                WHEN t3.n > 0 THEN ln(t3.n / x2.n)
                WHEN t2.n > 0 THEN ln(t2.n / x1.n) + (least(i, 3) - 2) * ln(0.4)
                WHEN t1.n > 0 THEN ln(t1.n / r.n) + (least(i, 3) - 1) * ln(0.4)
                ELSE least(i, 3) * ln(0.4) - ln(greatest(r.n, 1)) END AS s
            FROM grams g JOIN rest r ON r.doc_id = g.doc_id
            JOIN one t1 ON t1.doc_id = g.doc_id AND t1.c = g.c
            LEFT JOIN two t2 ON t2.doc_id = g.doc_id AND t2.b = g.b AND t2.c = g.c
            LEFT JOIN three t3 ON t3.doc_id = g.doc_id AND t3.a = g.a AND t3.b = g.b AND t3.c = g.c
            LEFT JOIN one x1 ON x1.doc_id = g.doc_id AND x1.c = g.b
            LEFT JOIN two x2 ON x2.doc_id = g.doc_id AND x2.b = g.a AND x2.c = g.b)
        SELECT r.doc_id, r.size AS n_tokens, round(coalesce(sum(s), 0.0), 4) AS log_score
        FROM rest r LEFT JOIN logs l ON l.doc_id = r.doc_id GROUP BY r.doc_id, r.size
    """,
    "op7_projection_neardup": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        reached AS (
            SELECT vec_id AS s, vec_id AS t FROM embeddings
            UNION
            SELECT reached.s, links.b FROM reached JOIN links ON links.a = reached.t),
        classes AS (SELECT s, min(t) AS component_id FROM reached GROUP BY s),
        degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN classes ON s = vec_id LEFT JOIN degrees ON a = vec_id
    """,
    "op12_rtree_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
            FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
}
