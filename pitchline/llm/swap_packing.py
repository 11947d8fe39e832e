"""Packing of token pieces into sequences: best fit, then a local search by swaps.

Tokens are counted per document in one pass over the texts; from then on only (doc_id, piece,
length) rows move. Pieces are dealt evenly to shards of about ``shard_rows`` rows, so no task
holds more, whatever the input; each shard wastes less than one sequence more than a global
packing would. In a shard, pieces are placed by best fit, longest first, then underfull sequences
exchange pieces one for one, two for one, one for two, or give one away, whenever that makes the
sum of squared fills grow. The sum is bounded and grows by whole numbers, so the search ends;
sequences that run empty disappear.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import texts, written
from pitchline.llm.byte_tokens import encoder

SHARD_ROWS = 20_000


def pieces(docs: DataFrame, vocabulary: str, limit: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and ``end_id``, cut into pieces
    of ``limit`` of which the first may be shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                rows: list[tuple[int, ...]] = []
                for i, ids in enumerate(encoder(vocabulary).packed(texts(some))):
                    ids += end
                    n = len(ids) // 4
                    cuts = [0, *range(n % limit or limit, n + 1, limit)]
                    rows += [(i, p, s, e - s, zlib.crc32(ids[4 * s : 4 * e]))
                             for p, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
                row, piece, start, length, crc = np.array(rows, np.int64).reshape(-1, 5).T
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: list[int], limit: int) -> list[list[int]]:
    """Bins of item numbers: items from long to short, each to the bin it leaves least room in."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r is set if a bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[item]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at = limit, len(bins)
            bins.append([])
        bins[at].append(item)
        room -= size
        by_room[room].append(at)
        rooms |= 1 << room
    return bins


def _best_shift(a: list[tuple[int, int]], b: list[tuple[int, int]], least: int, room: int
                ) -> tuple[int, list[int], list[int]] | None:
    """(gain, items of a, items of b) of the exchange that brings most from a to b, over ``least``
    and at most ``room``: none, one or two items against none, one or two, three in all at most.
    Both are sorted (length, item) lists."""
    best = (least, [], [])
    sizes = [x[0] for x in a]

    def single(back: int, items: list[int]) -> None:
        nonlocal best
        at = bisect_right(sizes, room + back) - 1
        if at >= 0 and sizes[at] - back > best[0]:
            best = (sizes[at] - back, [a[at][1]], items)

    single(0, [])
    for y, item in b:
        single(y, [item])
        if best[0] == room:
            return best
    for y, item in b:
        low, high = 0, len(a) - 1
        while low < high:
            gain = sizes[low] + sizes[high] - y
            if gain > room:
                high -= 1
            else:
                if gain > best[0]:
                    best = (gain, [a[low][1], a[high][1]], [item])
                low += 1
        if best[0] == room:
            return best
    for i, (y, one) in enumerate(b):
        for z, two in b[i + 1 :]:
            single(y + z, [one, two])
        if best[0] == room:
            return best
    return best if best[1] else None


def improve(bins: list[list[int]], lengths: list[int], limit: int) -> list[list[int]]:
    """Local search among underfull bins. From the emptiest, bins pass what they can to fuller
    ones; every exchange makes the sum of squared fills grow."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    under = [n for n, f in enumerate(fill) if f < limit]
    held = {n: sorted((lengths[i], i) for i in bins[n]) for n in under}
    changed = True
    while changed:
        changed = False
        for a in sorted(under, key=fill.__getitem__):
            for b in sorted((n for n in under if n != a and fill[a] <= fill[n] < limit), key=lambda n: -fill[n]):
                if not held[a]:
                    break
                if fill[b] == limit or fill[b] < fill[a]:
                    continue
                found = _best_shift(held[a], held[b], 0, limit - fill[b])
                if not found:
                    continue
                gain, give, back = found
                moved = {*give, *back}
                both = held[a] + held[b]
                held[a] = sorted(x for x in both if (x[1] in moved) != (x in held[a]))
                held[b] = sorted(x for x in both if x not in held[a])
                fill[a] -= gain
                fill[b] += gain
                changed = True
        under = [n for n in under if 0 < fill[n] < limit]
    for n, items in held.items():
        bins[n] = [i for _, i in items]
    return [b for b in bins if b]


def pack_lengths(lengths: list[int], limit: int) -> list[list[int]]:
    full = [[i] for i, n in enumerate(lengths) if n >= limit]
    rest = [i for i, n in enumerate(lengths) if n < limit]
    sizes = [lengths[i] for i in rest]
    return full + [[rest[i] for i in b] for b in improve(best_fit(sizes, limit), sizes, limit)]


def pack(docs: DataFrame, vocabulary: str, limit: int = 1024, end_id: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text is the
    one token ``end_id``. Repeated rows and null ids are packed as they are. An empty table gives
    an empty result.
    """
    found = written(pieces(docs, vocabulary, limit, end_id), "pieces")
    shards = max(1, -(-found.count() // shard_rows))
    dealt = found.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)))

    def run(group: pa.Table) -> pa.Table:
        number = group["shard"][0].as_py()
        lengths = group["length"].to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for n, members in enumerate(pack_lengths(lengths, limit)):
            at = 0
            for i in members:
                sequence[i], offset[i] = number << 32 | n, at
                at += lengths[i]
        return group.drop_columns(["shard"]).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offset))

    return dealt.groupBy("shard").applyInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
