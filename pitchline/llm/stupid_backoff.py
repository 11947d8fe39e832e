"""Language-model scores by stupid backoff, with counts from all other documents.

``S(w | a b) = c(a b w) / c(a b)`` if that n-gram was seen, else ``backoff`` times the score with
one word less of context, down to ``c(w) / N``; a word never seen gets one more factor of
``backoff`` and a count of one. Counts are those of the whole table less the document's own, so a text is not its
own evidence, and no n-gram is dropped from the tables.

The relations are those of a join of exploded n-grams with count tables, but packed, since there
is a row for almost every token of the corpus:

1. documents are dealt into blocks; a block explodes its n-grams into 64-bit hashes, groups them
   and sends each bucket of the hash range one sorted, compressed column of keys and counts;
2. a bucket sums the columns of all blocks into its part of the count table and joins it back:
   every block gets the total of each of its keys, in its own order;
3. a block puts the totals beside its n-grams and sums the logarithms per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import text_bytes

ORDER = 3
BACKOFF = 0.4
#: Bytes of text a block holds, which bounds a task's memory.
BLOCK_BYTES = 10 << 20

_U = np.uint64
_MIX = _U(0x9E3779B97F4A7C15)
#: Key of the empty n-gram, whose count is the number of tokens.
_EMPTY = _U(0)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return (x ^ (x >> _U(31))) | _U(1)  # never the empty n-gram's key


def _packed(column: np.ndarray) -> bytes:
    """Integers by byte planes: the planes that hardly vary compress to nothing."""
    wide = column.astype("<u8").view(np.uint8).reshape(-1, 8)
    return zstandard.compress(np.ascontiguousarray(wide.T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(_U)


class Grams:
    """The n-grams of a block of texts, as sorted distinct keys and as one key per position."""

    def __init__(self, texts: list[bytes], order: int) -> None:
        import xxhash

        number: dict[bytes, int] = {}
        ids, sizes = [], []
        for text in texts:
            ws = text.split()  # at ASCII white space, as bytes
            ids.append(np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int32, len(ws)))
            sizes.append(len(ws))
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), _U, len(number))
        del number
        word = hashes[np.concatenate([np.zeros(0, np.int32), *ids])]
        del ids
        self.sizes = np.array(sizes, np.int64)
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), self.sizes)
        self.at = (np.arange(len(word)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)).astype(np.int32)
        self.keys: list[np.ndarray] = []  # distinct keys of each order
        self.counts: list[np.ndarray] = []
        self.index: list[np.ndarray] = []  # of each position's n-gram among them, -1 if it has none
        self.own: list[np.ndarray] = []  # how often the position's text has that n-gram
        gram = np.zeros(len(word), _U)
        for n in range(1, order + 1):
            gram[1:] = gram[:-1]  # of the n - 1 words before each position
            if n == 1:
                gram[:] = 0
            gram = _mixed(gram * _MIX + word + _U(n))
            self._group(gram, np.flatnonzero(self.at >= n - 1))

    def _group(self, gram: np.ndarray, where: np.ndarray) -> None:
        g, t = gram[where], self.text[where]
        order = np.argsort(g, kind="stable")  # texts stay in order within a key
        g, t = g[order], t[order]
        new_key = np.concatenate(([True], g[1:] != g[:-1])) if len(g) else np.zeros(0, bool)
        new_own = new_key.copy()
        new_own[1:] |= t[1:] != t[:-1]
        starts = np.flatnonzero(new_key)
        index, own = np.full(len(gram), -1, np.int32), np.zeros(len(gram), np.int32)
        index[where[order]] = np.cumsum(new_key, dtype=np.int32) - 1
        runs = np.diff(np.append(np.flatnonzero(new_own), len(g)))
        own[where[order]] = np.repeat(runs, runs)
        self.keys.append(g[starts])
        self.counts.append(np.diff(np.append(starts, len(g))).astype(np.int32))
        self.index.append(index)
        self.own.append(own)

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, counts, order to restore) of all orders and the empty n-gram, keys ascending."""
        keys = np.concatenate([np.array([_EMPTY]), *self.keys])
        counts = np.concatenate([np.array([len(self.text)], np.int32), *self.counts])
        order = np.argsort(keys, kind="stable")
        return keys[order], counts[order], order

    def scores(self, totals: np.ndarray, backoff: float) -> np.ndarray:
        """Sum of log scores per text. ``totals``: counts in the whole table, empty n-gram first,
        then each order's keys."""
        rest = (int(totals[0]) - self.sizes)[self.text]  # tokens of the other texts
        others, at = [], 1
        for keys, index, own in zip(self.keys, self.index, self.own, strict=True):
            mine = totals[at : at + len(keys)].astype(np.int64)
            at += len(keys)
            others.append(np.where(index >= 0, mine[np.maximum(index, 0)] - own, 0) if len(keys) else np.zeros(len(self.text), np.int64))
        longest = np.minimum(self.at + 1, len(self.keys))
        log = -np.log(np.maximum(rest, 1)) + longest * np.log(backoff)  # never seen
        done = np.zeros(len(self.text), bool)
        for n in range(len(self.keys), 0, -1):
            seen = ~done & (longest >= n) & (others[n - 1] > 0)
            where = np.flatnonzero(seen)
            base = others[n - 2][where - 1] if n > 1 else rest[where]
            log[where] = np.log(others[n - 1][where] / base) + (longest[where] - n) * np.log(backoff)
            done |= seen
        return np.bincount(self.text, log, len(self.sizes))


def score(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, log_score, perplexity) for every row of ``docs``.

    Tokens are maximal runs without ASCII white space, case as it stands. ``log_score`` is the
    sum of the natural logarithms of S, ``perplexity`` exp(-log_score / n_tokens).

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or blank text has no
    tokens, a score of 0 and no perplexity. Each row is a document of its own, also rows of equal
    or null id. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    buckets = blocks  # keys of a bucket stay as many as those of a block, whatever the corpus
    width = -(-(1 << 64) // buckets)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.length("text"), F.substring("text", 1, 64)), F.lit(blocks)).cast("int"))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            offsets, raw = text_bytes(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("doc_id"),
                 pa.array([press.compress(raw[s:e]) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.binary())],
                ["block", "doc_id", "text"])

    def grams(table: pa.Table) -> Grams:
        press = zstandard.ZstdDecompressor()
        return Grams([press.decompress(t) for t in table["text"].to_pylist()], order)

    def edges(keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(keys, np.array([b * width for b in range(buckets)], _U)).tolist() + [len(keys)]

    def explode(table: pa.Table) -> pa.Table:
        keys, counts, _ = grams(table).table()
        cuts = edges(keys)
        parts = [(b, s, e) for b, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if e > s]
        return pa.table({
            "bucket": pa.array([b for b, _, _ in parts], pa.int32()),
            "block": pa.array([table["block"][0].as_py()] * len(parts), pa.int32()),
            "keys": pa.array([_packed(np.diff(keys[s:e], prepend=_U(0))) for _, s, e in parts], pa.binary()),
            "counts": pa.array([_packed(counts[s:e]) for _, s, e in parts], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unpacked(k), dtype=_U) for k in table["keys"].to_pylist()]
        ends = np.cumsum([len(k) for k in keys])
        flat = np.concatenate(keys)
        del keys
        order = np.argsort(flat, kind="stable")
        sorted_ = flat[order]
        number = np.cumsum(np.concatenate(([False], sorted_[1:] != sorted_[:-1])))
        del flat, sorted_
        counts = np.concatenate([_unpacked(c) for c in table["counts"].to_pylist()])
        sums = np.bincount(number, counts[order].astype(np.float64)).astype(np.int64)
        counts[order] = sums[number].astype(_U)
        return pa.table({"block": table["block"].combine_chunks(), "bucket": table["bucket"].combine_chunks(),
                         "totals": pa.array([_packed(c) for c in np.split(counts, ends[:-1])], pa.binary())})

    def rate(table: pa.Table, totals: pa.Table) -> pa.Table:
        block = grams(table)
        _, _, order = block.table()
        answers = sorted(zip(totals["bucket"].to_pylist(), totals["totals"].to_pylist(), strict=True))
        back = np.empty(len(order), _U)
        back[order] = np.concatenate([_unpacked(t) for _, t in answers])
        log = block.scores(back, backoff)
        return pa.table({"doc_id": table["doc_id"].combine_chunks(), "n_tokens": pa.array(block.sizes), "log_score": pa.array(log)})

    by_block = dealt.select("block", "doc_id", "text").mapInArrow(shrink, "block int, doc_id long, text binary").groupBy("block")
    counted = by_block.applyInArrow(explode, "bucket int, block int, keys binary, counts binary").groupBy("bucket").applyInArrow(
        total, "block int, bucket int, totals binary")
    rated = by_block.cogroup(counted.groupBy("block")).applyInArrow(rate, "doc_id long, n_tokens long, log_score double")
    return rated.withColumn("perplexity", F.when(F.col("n_tokens") > 0, F.exp(-F.col("log_score") / F.col("n_tokens"))))
