"""Periodic runs of words, found with a dictionary of basic factors.

The dictionary names every stretch of 1, 2, 4, ... words of a text, two stretches alike exactly if
they hold the same words: a stretch's name comes from the names of its halves. A stretch whose
name no other stretch of its text bears has no part in longer repeats and is dropped, so the tables
shrink as the stretches grow.

For the stretches of L words, each place's successor is the next place of the same name. Inside a
run of period q, L/2 < q <= L, of three turns or more, every place has its successor at exactly q
(a nearer one would give the run a smaller period): the places form q interleaved arithmetic
progressions, which lie side by side from the run's first word on. Neighbouring places with equal
distance are joined into one proposal, whose first place is the run's start and whose last stretch,
moved on by q, ends where the run ends. So a period comes from one length only and each run once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import group_starts

#: Words that are worked on together; a longer text is taken alone.
BATCH_WORDS = 400_000

RUN = "array<struct<start: long, length: long, period: long>>"


def find_runs(codes: np.ndarray, starts: np.ndarray, least_length: int, least_turns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the texts whose word codes lie one behind the other,
    each from its place in ``starts`` on; by start, then period."""
    n = len(codes)
    found: list[np.ndarray] = []
    places = np.arange(n, dtype=np.int64)
    text = np.zeros(n, np.int64)
    text[starts[starts < n]] = 1
    key = np.cumsum(text) * (int(codes.max(initial=0)) + 1) + codes  # equal words of one text
    longest = int(np.diff(np.append(starts, n)).max(initial=0))
    length = 1
    while len(places):
        order = np.argsort(key, kind="stable")  # equal keys stay in the order of their places
        key, at = key[order], places[order]
        same = key[1:] == key[:-1]
        gap = at[1:] - at[:-1]
        hit = np.flatnonzero(same & (gap <= length) & (2 * gap > length))
        first = np.argsort(at[hit])
        place, period = at[hit][first], gap[hit][first]
        if len(place):
            new = np.concatenate(([True], (place[1:] != place[:-1] + 1) | (period[1:] != period[:-1])))
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(place))) - 1 + period[head] + length
            long = size >= np.maximum(least_length, least_turns * period[head])
            found.append(np.stack([place[head][long], size[long], period[head][long]]))
        if 2 * length >= longest:
            break
        shared = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        name = np.full(n + length, -1, np.int64)
        name[at[shared]] = np.cumsum(np.concatenate(([True], ~same)))[shared]
        left = np.sort(at[shared])
        left = left[name[left + length] >= 0]
        places, key = left, name[left] * (n + 1) + name[left + length]
        length *= 2
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, size, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return start[order], size[order], period[order]


def _worked(texts: list[bytes], least_length: int, least_turns: int) -> tuple[list[list[dict]], list[bytes]]:
    words = [t.split() for t in texts]  # bytes split at exactly the six white space characters of ASCII
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    flat = pa.array([w for some in words for w in some], pa.large_binary())
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, length, period = find_runs(codes, ends - sizes, least_length, least_turns)
    doc = np.searchsorted(ends, start, side="right")
    cover = np.zeros(len(codes) + 1, np.int32)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.cumsum(cover[:-1]) == 0
    runs: list[list[dict]] = [[] for _ in texts]
    for d, s, m, q in zip(doc.tolist(), (start - (ends - sizes)[doc]).tolist(), length.tolist(), period.tolist(), strict=True):
        runs[d].append({"start": s, "length": m, "period": q})
    collapsed = []
    for some, has, end in zip(words, runs, ends.tolist(), strict=True):
        if has:
            some = [some[i] for i in np.flatnonzero(kept[end - len(some) : end]).tolist()]
        collapsed.append(b" ".join(some))
    return runs, collapsed


def periodic_runs(docs: DataFrame, least_length: int = 6, least_turns: int = 4) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of ``docs``.

    Words are what lies between the white space characters of ASCII. A run is a stretch of words
    with smallest period q that neither neighbour extends, of at least ``least_length`` words and
    ``least_turns`` (3 or more) times q. ``runs`` lists each run's first word (from 0), length and
    period by start, then period. ``collapsed`` joins by one space the words that no run holds
    behind its first q words.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null, empty and blank texts
    have no runs and an empty result. Rows with a null id and repeated rows are treated like
    others, each by itself; an empty table gives an empty result. Texts are worked on whole.
    """
    if least_turns < 3:
        raise ValueError("runs of fewer than three turns are not found by successors within the length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).fill_null(b"")
            sizes = np.cumsum(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False) // 5)
            for at, end in _parts(sizes // BATCH_WORDS):
                runs, collapsed = _worked(texts.slice(at, end - at).to_pylist(), least_length, least_turns)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, end - at), pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, runs {RUN}, collapsed string")


def _parts(lots: np.ndarray) -> list[tuple[int, int]]:
    starts = group_starts(lots).tolist()
    return list(zip(starts, [*starts[1:], len(lots)], strict=True))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs`` where one text in ten is made periodic from some word on: with
    h the CRC-32 of the id in decimal digits, g = floor(h / 10) and n words, for h % 10 = 0 each
    word i from a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8))."""
    blank = r"[\x20\x09-\x0D]+"
    h = F.crc32(F.col("doc_id").cast("long").cast("string"))
    words = F.expr(f"filter(split(text, '{blank.replace(chr(92), chr(92) * 2)}'), w -> w != '')")
    made = F.expr("""
        transform(words, (w, i) -> IF(i < a, w, words[cast(a + (i - a) % (1 + (size(words) - a) div (3 + g % 8)) AS int)]))""")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, words)).withColumn("g", F.expr("h div 10")).withColumn(
        "a", F.expr("g % nullif(size(words), 0)")).select(
        "doc_id", F.when(F.col("a").isNotNull() & (F.size("words") > 0), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def best_run() -> F.Column:
    """Of ``runs`` that of greatest length for its period, the first of equals."""
    return F.expr("""aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>),
        (best, r) -> IF(best IS NULL OR r.length * best.period > best.length * r.period, r, best))""")
