"""Bounded samples of labelled documents for fitting, the fold rule and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import written

def held_out(folds: int, fold: int) -> Column:
    """crc32(doc_id as text) mod ``folds`` is ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def training_ids(docs: DataFrame, labels: DataFrame, column: str, folds: int, fold: int) -> DataFrame:
    """(doc_id, label): labelled documents outside the held-out fold, once each. Null labels and
    ids are left out; an id labelled both ways counts as 1."""
    once = labels.where(f"doc_id is not null and {column} in (0, 1)").groupBy("doc_id").agg(
        F.max(column).cast("int").alias("label"))
    return once.where(~held_out(folds, fold)).join(docs.select("doc_id"), "doc_id", "left_semi")


def sampled(docs: DataFrame, ids: DataFrame, per_class: int, natural: int) -> tuple[DataFrame, DataFrame]:
    """Two disjoint samples (doc_id, label, text) of whole texts, bounded in rows: up to ``per_class`` of each
    label from two thirds of the ids, and up to ``natural`` of the other third in their natural mixture (the
    first again if there are none). Chosen by hashes of the id, so the choice does not depend on order or
    partitioning. The texts stay in Spark; the driver is to get what tasks make of them."""
    first, third = F.xxhash64("doc_id", F.lit(17)), F.pmod(F.xxhash64("doc_id", F.lit(18)), F.lit(3)) == 0
    chosen = [ids.where(~third & (F.col("label") == v)).orderBy(first).limit(per_class).withColumn("fit", F.lit(True)) for v in (0, 1)]
    mixed = ids.where(third).orderBy(first).limit(natural).withColumn("fit", F.lit(False))
    picked = chosen[0].unionByName(chosen[1]).unionByName(mixed)
    rows = written(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(picked), "doc_id").groupBy("doc_id", "label", "fit").agg(F.min("text").alias("text")), "sample")
    fit, rest = (rows.where(F.col("fit") == v).drop("fit") for v in (True, False))
    return fit, fit if rest.isEmpty() else rest


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (last: intercept) on the raw columns of ``x`` by Newton's method. A step is halved until it
    lowers the penalised loss: where the classes are all but separable, whole steps run away from the
    optimum and end in weights that fit nothing."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, np.where(y > 0, -1, 1) * (z @ w)).sum() + ridge / 2 * (w @ w))

    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        down = z.T @ (p - y) + ridge * w
        step = np.linalg.solve((z.T * (p * (1 - p))) @ z + ridge * np.eye(len(w)), down)
        now, gain = loss(w), 1e-4 * (down @ step)
        while loss(w - step) > now - gain + 1e-12 * (1 + now) and np.abs(step).max() >= 1e-9:
            step, gain = step / 2, gain / 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    w[:-1] /= scale
    w[-1] -= (w[:-1] * mean).sum()
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
