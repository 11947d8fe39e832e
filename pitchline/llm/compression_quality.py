"""Quality by compression: which of two zstandard dictionaries describes a text better?

One dictionary is built from good, one from bad labelled text. A text is compressed in small
blocks with either and with none. The difference of the two sizes per byte says which class its
strings come from; the size without a dictionary says how repetitive it is. A logistic fit of
second degree on further labelled rows turns both into a calibrated score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.llm.common import process_cache, text_bytes
from pitchline.llm.labelled import held_out, logistic, probability, sampled, training_ids

BLOCK = 512
LEVEL = 3
DICTIONARY_BYTES = 112_640
#: Rows of each class the dictionaries are built from, and rows the calibration is fitted on.
FIT_ROWS = 1500
CALIBRATION_ROWS = 4000


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of the terms of ``expanded`` and the intercept


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their text itself
        return b"".join(samples)[-DICTIONARY_BYTES:] or b"\0" * 8


def _samples(texts: list[str], other: list[str]) -> list[bytes]:
    """Lines of one class that the other lacks, in blocks: lines of either are no evidence."""
    lines = {line for t in texts for line in t.split("\n")} - {line for t in other for line in t.split("\n")}
    raw = [line.encode() for line in sorted(lines)]
    return [r[i : i + BLOCK] for r in raw for i in range(0, len(r), BLOCK)]


class Compressors:
    def __init__(self, good: bytes, bad: bytes) -> None:
        # the sizes only are used: no frame fields, which are the same for all
        plain = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        self.with_good = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(good), **plain)
        self.with_bad = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(bad), **plain)
        self.alone = zstandard.ZstdCompressor(**plain)

    def features(self, text: memoryview | bytes) -> tuple[float, float]:
        """(normalised difference of sizes, size alone per byte); zeros for an empty text."""
        n = len(text)
        if not n:
            return 0.0, 0.0
        good = bad = alone = 0
        for at in range(0, n, BLOCK):
            block = text[at : at + BLOCK]
            good += len(self.with_good.compress(block))
            bad += len(self.with_bad.compress(block))
            alone += len(self.alone.compress(block))
        return (bad - good) / n, alone / n


def expanded(x: np.ndarray) -> np.ndarray:
    """Both features, bounded, with their squares and product: how much a difference counts
    depends on how repetitive the text is."""
    a, b = np.clip(x[:, 0], -0.3, 0.3), np.clip(x[:, 1], 0.0, 1.0)
    return np.c_[a, b, a * a, a * b, b * b]


def fit(docs: DataFrame, labels: DataFrame, folds: int, fold: int, fit_rows: int = FIT_ROWS,
        calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """The model from labelled rows outside the held-out fold. With rows of one class only, the
    score is that class for all; with none it is 0.5."""
    first, rest = sampled(docs, training_ids(docs, labels, "quality", folds, fold), fit_rows, calibration_rows)
    rows = [(r.text, r.label) for r in first.orderBy("doc_id").collect()]
    good, bad = ([t for t, v in rows if v == want] for want in (1, 0))
    if not good or not bad:
        return Model(b"", b"", (0.0,) * 5 + (0.0 if not rows else 30.0 if good else -30.0,))
    d = _dictionary(_samples(good, bad)), _dictionary(_samples(bad, good))
    sized = features(rest, Model(*d, ()), ["label"]).orderBy("doc_id").collect()
    x = np.array([(r.difference, r.alone) for r in sized])
    return Model(*d, tuple(logistic(expanded(x), np.array([r.label for r in sized], float)).tolist()))


def features(docs: DataFrame, model: Model, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, columns of ``keep``, difference, alone): the features of every whole text, and with the
    weights of a fitted model the ``score`` they give."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries: bounded

    key = hashlib.sha256(model.good + b"/" + model.bad).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        c = process_cache("quality", key, lambda: Compressors(m.good, m.bad))
        w = np.array(m.weights or (0.0,) * 6)
        for batch in batches:
            offsets, raw = text_bytes(batch.column("text"))
            view = memoryview(raw)
            x = np.array([c.features(view[s:e]) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(c) for c in keep), pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(probability(expanded(x), w))],
                ["doc_id", *keep, "difference", "alone", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), *keep, *({"text"} - set(keep)))
    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in ("doc_id", *keep)),
                                              *(T.StructField(c, T.DoubleType()) for c in ("difference", "alone", "score"))]))


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, columns of ``keep``, score): the probability of good quality of every whole text."""
    return features(docs, model, keep).select("doc_id", *keep, "score")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3,
             fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, columns of ``keep``, held_out, score, predicted) for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not looked at. A null text counts as
    empty and gets the score of features zero. Null ids are scored and never learned from;
    repeated rows are scored each. Fitting reads a bounded sample, scoring every whole text.
    """
    model = fit(docs, labels, folds, fold, fit_rows, calibration_rows)
    return score(docs, model, keep).select(
        "doc_id", *keep, held_out(folds, fold).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
