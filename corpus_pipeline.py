"""Training-data pipeline over ``documents``; each stage's result is written and reread.

Every stage takes all that its predecessor kept and needs ``doc_id`` and ``text``. Null texts count
as empty. Every row is a document of its own: rows without an id and rows that share one are
compared like others, and only those go whose texts are near copies. Empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm import compression_quality, golay_simhash, repeat_tree, swap_packing, toxicity_fm
from pitchline.llm.common import row_keyed, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    rated = compression_quality.classify(docs, table(spark, sf_dir, "labels"), folds=5, fold=0, threshold=0.3, keep=COLUMNS[1:])
    return rated.where("predicted = 1").select(*COLUMNS)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier calls toxic go."""
    rated = toxicity_fm.classify(docs, table(spark, sf_dir, "labels"), folds=3, fold=1, threshold=0.7, keep=COLUMNS[1:])
    return rated.where("predicted = 0").select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group, those without an id last."""
    rows = row_keyed(docs, "keyed")
    found = golay_simhash.simhash_components(rows.select(F.col("row_key").alias("doc_id"), "text"), shingle=4, max_bits=4)
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias("row_key"))
    return rows.join(keep, "row_key", "left_semi").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 100 bytes or more that also occur earlier out of the texts, drawn in to
    whole characters. A document that loses all of its text stays, with an empty one."""
    kept = repeat_tree.dedup(docs, length=100, whole_characters=True, keep=["lang", "source"])
    return kept.withColumn("text", F.col("kept").cast("string")).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens."""
    return swap_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024, end_id=2)


STAGES = [
    ("quality_filter", quality_filter),
    ("toxicity_filter", toxicity_filter),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: SQL can't express the stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
