"""Toxicity by a factorization machine over hashed terms of short windows of words.

The logit of a window is w0 + sum of w_i over its distinct terms + sum over pairs of <v_i, v_j>.
The pair terms learn what additive weights miss, such as an insult that only counts next to the
name of a group. A document's logit is the largest of its half-overlapping windows, so length
does not dilute or inflate it; a logistic fit on further labelled rows calibrates it.

A word gives several terms, itself and its head, so forms of a word met for the first time count
too. Windows of a toxic text need not all be toxic: after a few rounds on all of them, only the
most toxic window of such a text is still taken for a positive example.

Terms are hashed to 32 bits; those of two or more texts of the fitting sample take part, which bounds
the model by that sample. First those learn whose own share of texts differs between the classes, then all
on what these leave unexplained: partners of a toxic pair may be as frequent in clean texts, and toxic
words may be rare.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.llm.common import group_starts, process_cache, texts
from pitchline.llm.labelled import held_out, logistic, probability, sampled, training_ids

#: Words of a half window; a window is two neighbours.
HALF = 16
FACTORS = 8
#: Rounds on all windows, and rounds on the most toxic window of each toxic text.
EPOCHS, SHARPER = 2, 4
#: Lengths of the heads of words that are terms beside the word.
HEADS = (4, 5, 6)
#: Terms of a word at most.
WIDTH = 1 + len(HEADS)
#: Rows of each class the machine is fitted on, and rows the calibration is fitted on.
FIT_ROWS = 2500
CALIBRATION_ROWS = 4000
#: Words whose hash a worker remembers.
CACHE_ENTRIES = 200_000
#: Weights below this, on both the linear and the pair side, are as good as none.
SMALL = 0.02
RIDGE = 0.01
#: Standard errors by which the share of a term that learns first differs between the classes.
TELLING = 3.5
#: Windows whose pair terms are summed at once.
CHUNK = 2_000

_WORD = re.compile(r"\w+")
_NO_HEADS = array("i", [-1] * len(HEADS))


@dataclass(frozen=True)
class Model:
    terms: np.ndarray  # sorted 32-bit hashes
    linear: np.ndarray  # their weights
    factors: np.ndarray  # their factor vectors
    bias: float
    weights: tuple[float, float]  # calibration: slope, intercept


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def hashed(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass"))


def terms_of(word: str) -> list[int]:
    """Hashes of a word's terms: the word and its heads."""
    return [hashed(word), *(hashed("^" + word[:n]) for n in HEADS if len(word) >= n)]


class _Learned(dict):
    """What is known of words; of a new word it is found out when it is first asked for."""

    def __init__(self, learn: Callable[[str], Any]) -> None:
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> Any:
        value = self[word] = self.learn(word)
        return value


class Rows:
    """Rows of the known terms of words, each word looked up once, and the heads of words that begin alike."""

    def __init__(self, terms: np.ndarray) -> None:
        self.place = {int(t): i for i, t in enumerate(terms.tolist())}
        self.forget()

    def forget(self) -> None:
        self.number, self.heads = _Learned(self._number), _Learned(self._heads)
        self.known = array("i", [-1] * WIDTH)  # the rows of each number, -1 for a term that isn't known; 0: none is

    def _heads(self, head: str) -> array:
        """Rows of the heads of all words that begin with the longest, empty if none is known."""
        rows = [self.place.get(t, -1) for t in terms_of(head)[1:]]
        return array("i", rows + [-1] * (len(HEADS) - len(rows)) if max(rows, default=-1) >= 0 else [])

    def _number(self, word: str) -> int:
        own, heads = self.place.get(hashed(word), -1), self.heads[word[: HEADS[-1]]]
        if own < 0 and not heads:
            return 0
        number = len(self.known) // WIDTH
        self.known.append(own)
        self.known.extend(heads or _NO_HEADS)
        return number

    def of(self, ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(position of word, row) of all known terms in a list of words."""
        number = np.fromiter(map(self.number.__getitem__, ws), np.int64, len(ws))
        at = np.flatnonzero(number)
        rows = np.frombuffer(self.known, np.int32).reshape(-1, WIDTH)[number[at]]
        word, column = np.nonzero(rows >= 0)
        return at[word], rows[word, column].astype(np.int64)


def windows(at: np.ndarray, rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, term row), each distinct term of a window once. ``at`` and ``rows`` are what
    ``Rows.of`` finds in ``count`` words; window i covers half windows i and i + 1."""
    half, last = at // HALF, max((count - 1) // HALF - 1, 0)
    first, second = np.maximum(half - 1, 0), np.minimum(half, last)
    key = np.sort(np.concatenate((first << 32 | rows, second << 32 | rows)))
    key = key[group_starts(key)]
    return key >> 32, key & 0xFFFFFFFF


def logits(window: np.ndarray, row: np.ndarray, linear: np.ndarray, factors: np.ndarray, bias: float) -> np.ndarray:
    """Logits of the windows that have known terms."""
    if not len(window):
        return np.zeros(0)
    starts = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1])))
    v = factors[row]
    total = np.add.reduceat(v, starts, axis=0)
    pairs = 0.5 * ((total * total).sum(1) - np.add.reduceat((v * v).sum(1), starts))
    return bias + np.add.reduceat(linear[row], starts) + pairs


def numbered(text: str) -> tuple[str, bytes]:
    """A text's distinct words and the 32-bit numbers of all of its words among them."""
    number: dict[str, int] = {}
    ws = words(text)
    numbers = np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int32, len(ws)).tobytes()
    return " ".join(number), numbers


class _Sample:
    """The words of the fitting sample as numbers, and the terms of each distinct word: a row of
    hashes, -1 where a word is too short for a head."""

    def __init__(self, labelled: list[tuple[str | tuple[str, bytes], int]]) -> None:
        number: dict[str, int] = {}
        self.texts = []
        for text, _ in labelled:
            distinct, own = numbered(text) if isinstance(text, str) else text
            ws = distinct.split()
            self.texts.append(np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int32, len(ws))[np.frombuffer(own, np.int32)])
        self.labels = np.array([y for _, y in labelled])
        self.terms = np.full((len(number), WIDTH), -1, np.int64)
        for word, n in number.items():
            found = terms_of(word)
            self.terms[n, : len(found)] = found

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """Terms of two or more texts, and whether their share of texts differs between the classes by
        ``TELLING`` standard errors."""
        terms, back = np.unique(self.terms, return_inverse=True)
        back = back.reshape(self.terms.shape).astype(np.int32)
        counts = np.zeros((2, len(terms)), np.int64)
        for text, label in zip(self.texts, self.labels, strict=True):
            counts[label, np.unique(back[np.unique(text)])] += 1
        held = terms >= 0
        terms, (clean, toxic) = terms[held], counts[:, held]
        n = [max(1, int((self.labels == want).sum())) for want in (0, 1)]
        p = (clean + toxic) / sum(n)
        z = (toxic / n[1] - clean / n[0]) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n[0] + 1 / n[1]))
        keep = clean + toxic > 1
        return terms[keep], np.abs(z[keep]) > TELLING

    def windows(self, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, row of ``terms``) of each text."""
        place = np.minimum(np.searchsorted(terms, self.terms), max(len(terms) - 1, 0))
        rows = np.where(terms[place] == self.terms, place, -1) if len(terms) else np.full(self.terms.shape, -1)
        for text in self.texts:
            mine = rows[text]
            at, column = np.nonzero(mine >= 0)
            yield windows(at, mine[at, column], len(text))


def fit_machine(labelled: list[tuple[str | tuple[str, bytes], int]], epochs: int = EPOCHS, sharper: int = SHARPER, seed: int = 11
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(terms, linear, factors, bias) by AdaGrad on the windows of the texts."""
    sample = _Sample(labelled)
    terms, telling = sample.repeated()
    sizes, rows, owner = array("i"), array("i"), array("i")  # grow in place: one copy of the windows is held
    for number, (window, row) in enumerate(sample.windows(terms)):
        count = np.bincount(window).astype(np.int32)  # windows behind a text's last known term are left out
        sizes.frombytes(count.tobytes())
        rows.frombytes(row.astype(np.int32).tobytes())
        owner.frombytes(np.full(len(count), number, np.int32).tobytes())
    base = len(sizes)
    rng = np.random.default_rng(seed)
    linear, factors, bias = np.zeros(len(terms)), rng.normal(0, 0.05, (len(terms), FACTORS)), 0.0
    if not base or not len(terms):
        return terms, linear, factors * 0, bias
    all_row, owner = np.frombuffer(rows, np.int32), np.frombuffer(owner, np.int32)
    all_first = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, np.int32), dtype=np.int64)))
    toxic = sample.labels.astype(float)
    y = toxic[owner]
    factors[~telling] *= 0.6
    g_linear, g_factors, g_bias = np.where(telling, 1e-2, 1.0), np.full((len(terms), FACTORS), 1e-2), 1e-2
    rounds = range(epochs + sharper)
    for everything, epoch in [*((False, e) for e in rounds if telling.any()), *((True, e) for e in rounds)]:
        if not epoch:
            row, first = all_row, all_first
            if not everything:
                tells = np.flatnonzero(telling[all_row]).astype(np.int32)
                row, first = all_row[tells], np.searchsorted(tells, all_first)
                del tells
            filled = np.flatnonzero(np.diff(first))
        use, weight = filled, np.ones(base)
        if epoch >= epochs:
            z = np.full(base, -np.inf)
            for some in np.split(filled, range(CHUNK, len(filled), CHUNK)):
                part = slice(first[some[0]], first[some[-1] + 1])
                z[some] = logits(np.repeat(some, first[some + 1] - first[some]), row[part], linear, factors, bias)
            best = np.full(len(labelled), -np.inf)
            np.maximum.at(best, owner, z)
            use = filled[(y[filled] == 0) | (z[filled] >= best[owner[filled]])]
        share = y[use].sum()
        if 0 < share < len(use):  # either class weighs a half, no one window over 20 times
            weight = np.where(y > 0, min(20.0, len(use) / (2 * share)), min(20.0, len(use) / (2 * (len(use) - share))))
        for some in np.array_split(rng.permutation(use), max(1, len(use) // 256)):
            size = first[some + 1] - first[some]
            starts = np.cumsum(size) - size
            at = np.arange(size.sum()) - np.repeat(starts, size) + np.repeat(first[some], size)
            r = row[at]
            v = factors[r]
            total = np.add.reduceat(v, starts, axis=0)
            z = bias + np.add.reduceat(linear[r], starts) + 0.5 * (
                (total * total).sum(1) - np.add.reduceat((v * v).sum(1), starts))
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) * weight[some]
            each = np.repeat(d, size)
            used, back = np.unique(r, return_inverse=True)
            dl = np.bincount(back, each, len(used)) + RIDGE * linear[used]
            push = each[:, None] * (np.repeat(total, size, axis=0) - v)
            dv = np.stack([np.bincount(back, push[:, f], len(used)) for f in range(FACTORS)], 1) + RIDGE * factors[used]
            g_linear[used] += dl * dl
            g_factors[used] += dv * dv
            g_bias += d.sum() ** 2
            linear[used] -= 0.1 * dl / np.sqrt(g_linear[used])
            factors[used] -= 0.02 * dv / np.sqrt(g_factors[used])
            bias -= 0.1 * d.sum() / np.sqrt(g_bias)
    keep = (np.abs(linear) > SMALL) | ((factors**2).sum(1) > SMALL)
    return terms[keep], linear[keep], factors[keep], float(bias)


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.rows = Rows(model.terms)

    def logit(self, text: str) -> float:
        """Largest window logit; the bias if no window has a known term."""
        ws = words(text)
        if len(self.rows.number) > CACHE_ENTRIES:
            self.rows.forget()
        m = self.model
        z = logits(*windows(*self.rows.of(ws), len(ws)), m.linear, m.factors, m.bias)
        return max(float(z.max()), m.bias) if len(z) else m.bias


def _numbered(sample: DataFrame) -> list[tuple[tuple[str, bytes], int]]:
    """((distinct words, numbers), label) of whole texts, made in Spark tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                found = [numbered(t) for t in texts(some)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("label"), pa.array([d for d, _ in found], pa.string()), pa.array([n for _, n in found], pa.binary())],
                    ["doc_id", "label", "distinct", "numbers"])

    schema = T.StructType([sample.schema["doc_id"], sample.schema["label"], T.StructField("distinct", T.StringType()), T.StructField("numbers", T.BinaryType())])
    return [((r.distinct, bytes(r.numbers)), r.label) for r in sample.select("doc_id", "label", "text").mapInArrow(run, schema).orderBy("doc_id").collect()]


def fit(docs: DataFrame, labels: DataFrame, folds: int, fold: int, fit_rows: int = FIT_ROWS,
        calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """The model from labelled rows outside the held-out fold. With rows of one class only, the
    score is that class for all; with none it is 0.5."""
    first, rest = sampled(docs, training_ids(docs, labels, "toxic", folds, fold), fit_rows, calibration_rows)
    rows = _numbered(first)
    seen = {y for _, y in rows}
    if len(seen) < 2:
        flat = 0.0 if not seen else 30.0 if 1 in seen else -30.0
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)), 0.0, (0.0, flat))
    terms, linear, factors, bias = fit_machine(rows)
    scored = _scored(rest, Model(terms, linear, factors, bias, (1.0, 0.0)), ["label"]).orderBy("doc_id").collect()
    w = logistic(np.array([[r.logit] for r in scored]), np.array([r.label for r in scored], float))
    return Model(terms, linear, factors, bias, (float(w[0]), float(w[1])))


def _scored(docs: DataFrame, model: Model, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, columns of ``keep``, logit, score) of whole texts."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # terms of a bounded sample
    key = hashlib.sha256(b"/".join(x.tobytes() for x in (model.terms, model.linear, model.factors))
                         + repr((model.bias, model.weights)).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = process_cache("toxicity", key, lambda: Scorer(sent.value))
        w = np.array(scorer.model.weights)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                z = np.array([scorer.logit(t) for t in texts(some)])
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), *(some.column(c) for c in keep), pa.array(z), pa.array(probability(z.reshape(-1, 1), w))],
                    ["doc_id", *keep, "logit", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), *keep, *({"text"} - set(keep)))
    return rows.mapInArrow(run, T.StructType([*(rows.schema[c] for c in ("doc_id", *keep)),
                                              *(T.StructField(c, T.DoubleType()) for c in ("logit", "score"))]))


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, columns of ``keep``, score): the probability that a whole text is toxic."""
    return _scored(docs, model, keep).select("doc_id", *keep, "score")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, threshold: float = 0.7,
             fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, columns of ``keep``, held_out, score, predicted) for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not looked at. A null or empty text
    has the bias for a logit. Null ids are scored and never learned from; repeated rows are
    scored each. Fitting reads a bounded sample, scoring every whole text.
    """
    model = fit(docs, labels, folds, fold, fit_rows, calibration_rows)
    return score(docs, model, keep).select(
        "doc_id", *keep, held_out(folds, fold).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
