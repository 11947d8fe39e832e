"""Exact substring de-duplication by the interval tree of an enhanced suffix array.

Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes that covers it also starts
earlier (smaller doc_id, or same document and earlier start).

1. **Anchors.** In every window of ``length`` bytes the ``k``-gram with the least hash is its
   anchor. That depends on nothing but the window, so equal windows meet at equal anchors. Around
   an anchor lies its context: all bytes of the windows whose anchor it is.
2. **Equal contexts.** Copies within a lot of anchors are told at once; the rest is sorted by (hash, 128-bit context hash, place). Every context
   but the first of a class of equal ones is a copy from end to end. Only the first goes on, and
   only if the same anchor has other contexts too.
3. **Suffix array.** The remaining contexts of an anchor are cut from the texts, and their
   suffixes sorted with their common-prefix lengths. A stack scan over that array walks the
   common-prefix intervals from the inside out. An interval of ``length`` bytes or more whose
   occurrences have differing bytes on their left is a maximal repeat: a group with *all* its
   occurrences. One whose left bytes all agree is part of a longer repeat and is not given out.
4. In each group all but the first occurrence are marked. The scan hands each interval's first
   occurrence on to the interval around it, so an occurrence is marked once, with the longest
   repeat in which it isn't first. Marked spans are joined per document.

A task holds a few whole anchor groups at a time. An anchor with more than ``hot`` differing
contexts is not sorted in one task: its windows are hashed and dealt out one by one instead
(``_window_marks``), which gives the same marks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.llm.common import group_starts, process_cache, row_keyed, sorted_groups, text_bytes, written

LENGTH = 100
K = 20
#: Bytes of text that are hashed in one go, with a dozen numbers for each of them.
CHUNK = 1 << 17
#: Anchors that are looked through for copies at a time.
ANCHORS = 1 << 17
#: Contexts whose suffixes are sorted at a time, but for an anchor that has more.
CONTEXTS = 1 << 12
#: Differing contexts of one anchor that one task sorts.
HOT = 50_000

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = _U(pow(int(_P), -1, 1 << 64))
    up, down = np.full(n, _P, _U), np.full(n, inverse, _U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _symbols() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=_U) | _U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _sliding(x: np.ndarray, w: int, fold: np.ufunc) -> np.ndarray:
    """fold over every window of ``w`` neighbours."""
    span = 1
    while 2 * span <= w:
        x = fold(x[:-span], x[span:])
        span *= 2
    return fold(x[: len(x) - (w - span)], x[w - span :]) if w > span else x


class _Hasher:
    """Hashes of any substring of a chunk by prefix sums modulo 2^64."""

    def __init__(self, size: int) -> None:
        self.symbols = _symbols()
        self.up, self.down = _powers(size + 1)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            self.up, self.down = _powers(2 * len(data) + 1)
        out = np.zeros(len(data) + 1, _U)
        np.cumsum(self.symbols[data] * self.up[: len(data)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((prefix[end] - prefix[start]) * self.down[start])


def _hasher(size: int) -> _Hasher:
    """A hasher of ``size`` bytes, the worker's own unless there are more than go in one go."""
    return process_cache("repeat_tree", CHUNK, lambda: _Hasher(CHUNK)) if size <= CHUNK else _Hasher(size)


def _anchors(data: np.ndarray, ends: np.ndarray, hasher: _Hasher, length: int, k: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position in data, anchor hash, context start, context end) of all anchors of
    the texts laid end to end in ``data``; a text ends before each of ``ends``."""
    none = np.zeros(0, np.int64)
    n, w = len(data), length - k + 1
    if n < length:
        return none, none, none.astype(_U), none, none
    prefix = hasher.prefix(data)
    grams = n - k + 1
    h = _mixed((prefix[k:] - prefix[:grams]) * hasher.down[:grams]) | _U(1)  # 0 stands for no window
    least = _sliding(h, w, np.minimum)  # by window start
    starts = np.concatenate(([0], ends[:-1]))
    whole = np.zeros(len(least) + 1, np.int32)  # windows that lie in one text
    has = ends - starts >= length
    np.add.at(whole, starts[has], 1)
    np.add.at(whole, ends[has] - length + 1, -1)
    least[np.cumsum(whole[:-1]) == 0] = 0
    padded = np.concatenate((np.zeros(w - 1, _U), least, np.zeros(w - 1, _U)))
    at = np.flatnonzero(_sliding(padded, w, np.maximum) == h)
    edge = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    first, last = edge, np.append(edge[1:], len(least)) - 1  # runs of windows with the same least hash
    first, last = first[least[first] > 0], last[least[first] > 0]
    low, high, anchor = [], [], []
    number, run, before = np.searchsorted(at, first), np.arange(len(first)), np.full(len(first), -1)
    while len(run):  # of ties in a window the first is its anchor: a run's anchors, one a round
        inside = number < len(at)
        inside[inside] = at[number[inside]] <= last[run[inside]] + w - 1
        number, run = number[inside], run[inside]
        a = at[number]
        its = h[a] == least[first[run]]
        from_ = np.maximum(np.maximum(first[run], a - w + 1), before[run] + 1)
        to = np.minimum(last[run], a)
        before[run[its]] = a[its]
        its &= from_ <= to
        low.append(from_[its])
        high.append(to[its] + length)
        anchor.append(a[its])
        number = number + 1
    low, high, anchor = np.concatenate(low or [none]), np.concatenate(high or [none]), np.concatenate(anchor or [none])
    return np.searchsorted(ends, low, side="right"), anchor, h[anchor], low, high


def anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(h, c, doc_id, low, high, copy): anchor hash, context hash and place of the context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _found(batches, length, k)

    return docs.mapInArrow(run, "h long, c long, doc_id long, low int, high int, copy boolean")


def _found(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[pa.RecordBatch]:
    second = _U(0xA24BAED4963EE407)
    for batch in batches:
        offsets, raw = text_bytes(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        first, parts, rows = 0, [], 0
        while first < len(ids):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1)
            data = raw[offsets[first] : offsets[last]]
            ends = (offsets[first + 1 : last + 1] - offsets[first]).astype(np.int64)
            hasher = _hasher(len(data))
            text, _, h, low, high = _anchors(data, ends, hasher, length, k)
            if len(text):
                prefix = hasher.prefix(data)
                c = hasher.of(prefix, low, high) + (high - low).astype(_U) * second
                start = np.concatenate(([0], ends[:-1]))[text]
                parts.append((h, c, ids[first:last][text], (low - start).astype(np.int32), (high - start).astype(np.int32)))
                rows += len(text)
            first = last
            if rows >= ANCHORS:
                yield _combined(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                parts, rows = [], 0
        if parts:
            yield _combined(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _combined(h: np.ndarray, c: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """Pre-aggregation: of equal contexts in a lot all but the first are copies already. They
    get a key of their own, so a frequent anchor sends one row a lot to its task."""
    order = np.lexsort((low, ids, c, h))
    h, c, ids, low, high = h[order], c[order], ids[order], low[order], high[order]
    copy = np.concatenate(([False], (h[1:] == h[:-1]) & (c[1:] == c[:-1])))
    place = (ids.astype(_U) << _U(32)) + low.astype(_U)
    h = np.where(copy, _mixed(place * _P), h)
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(ids), pa.array(low), pa.array(high), pa.array(copy)],
        ["h", "c", "doc_id", "low", "high", "copy"])


def _classed(found: DataFrame, hot: int) -> DataFrame:
    """Rows (doc_id, low, high, h, contexts): ``contexts`` is 0 for a copy of an earlier context,
    which is marked whole, else the number of differing contexts that the anchor has, or
    ``hot + 1`` if that is more than ``hot``. Holds at most ``hot`` contexts and one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["doc_id", "low", "high", "h"]
        before, over = (None, None), None  # last (h, c) seen; the anchor known to have too many
        held: pa.Table | None = None  # first contexts of the open anchor

        def out(rows: pa.Table, contexts: np.ndarray) -> list[pa.RecordBatch]:
            return rows.append_column("contexts", pa.array(contexts, pa.int64())).combine_chunks().to_batches()

        for batch in batches:
            part = pa.Table.from_batches([batch])
            yield from out(part.filter(part["copy"]).select(columns), np.zeros(int(np.sum(part["copy"].to_numpy())), np.int64))
            part = part.filter(pa.array(~part["copy"].to_numpy()))
            if not part.num_rows:
                continue
            h, c = part["h"].to_numpy(), part["c"].to_numpy()
            new = np.concatenate(([(h[0], c[0]) != before], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
            before = (h[-1], c[-1])
            yield from out(part.filter(pa.array(~new)).select(columns), np.zeros(int((~new).sum()), np.int64))
            rows = part.filter(pa.array(new)).select(columns)
            held = pa.concat_tables([held, rows]) if held is not None else rows
            keys = held["h"].to_numpy()
            starts = group_starts(keys)
            sizes = np.diff(np.append(starts, len(keys)))
            kinds = np.repeat(np.where((sizes > hot) | (keys[starts] == over), hot + 1, sizes), sizes)
            open_ = len(starts) > 0 and keys[-1] == h[-1]
            ready = len(keys) - (sizes[-1] if open_ and kinds[-1] <= hot else 0)
            over = h[-1] if open_ and kinds[-1] > hot or over == h[-1] else None
            done = kinds[:ready] > 1
            yield from out(held.slice(0, ready).filter(pa.array(done)), kinds[:ready][done])
            held = held.slice(ready)
        if held is not None and held.num_rows:
            keys = held["h"].to_numpy()
            sizes = np.diff(np.append(group_starts(keys), len(keys)))
            kinds = np.repeat(sizes, sizes)
            yield from out(held.filter(pa.array(kinds > 1)), kinds[kinds > 1])

    order = found.repartition("h").sortWithinPartitions("h", "c", "doc_id", "low")
    return order.mapInArrow(run, "doc_id long, low int, high int, h long, contexts long")


def _span() -> Column:
    """A span in one long: start in the upper, end in the lower half."""
    return F.shiftleft(F.col("low").cast("long"), 32).bitwiseOR(F.col("high").cast("long"))


def _unpacked(span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return span >> 32, span & 0xFFFFFFFF


def _cut(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, doc_id, low, context): the bytes of the wanted contexts."""
    places = wanted.groupBy("doc_id").agg(F.collect_list(F.struct(_span().alias("span"), "h")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = text_bytes(batch.column("text"))
            lists = batch.column("places")
            flat = lists.flatten()
            number = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
            base = offsets[:-1][number]
            low, high = _unpacked(flat.field("span").to_numpy())
            for at in range(0, len(low), 20_000):
                some = slice(at, at + 20_000)
                cuts = [raw[s:e].tobytes() for s, e in zip(
                    (base[some] + low[some]).tolist(), (base[some] + high[some]).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [flat.field("h")[some], batch.column("doc_id").take(pa.array(number[some])),
                     pa.array(low[some].astype(np.int32)), pa.array(cuts, pa.binary())], ["h", "doc_id", "low", "context"])

    return docs.join(places, "doc_id").mapInArrow(
        run, "h long, doc_id long, low int, context binary")


def _suffix_groups(strings: list[bytes], group: np.ndarray, length: int) -> Iterator[list[tuple[bytes, int, int, int]]]:
    """Sorted suffixes (bytes, byte before or -1, string number, start) in lots: those of a group
    that agree in their first ``length`` bytes and may begin a maximal repeat."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    data = np.frombuffer(b"".join(strings), np.uint8)
    ends = np.cumsum(sizes)
    windows = np.maximum(sizes - length + 1, 0)
    after = np.cumsum(windows)
    total = int(after[-1]) if len(after) else 0
    if not total:
        return
    key, left = np.empty(total, _U), np.empty(total, np.int16)  # by window; nothing else is held for all of them
    salt = _mixed(group.astype(_U) * _P)
    s = 0
    while s < len(strings):
        begin = int(ends[s] - sizes[s])
        e = max(s + 1, int(np.searchsorted(ends, begin + CHUNK, side="right")))
        part, many = data[begin : ends[e - 1]], windows[s:e]
        its = slice(int(after[s] - windows[s]), int(after[e - 1]))
        opens = ends[s:e] - sizes[s:e] - begin
        at = np.arange(its.stop - its.start) + np.repeat(opens - (after[s:e] - many - its.start), many)
        if len(at):
            hasher = _hasher(len(part))
            key[its] = hasher.of(hasher.prefix(part), at, at + length) ^ np.repeat(salt[s:e], many)
            left[its] = np.where(at > np.repeat(opens, many), part[np.maximum(at - 1, 0)].astype(np.int16), np.int16(-1))
        s = e
    order = np.argsort(key, kind="stable")
    runs = group_starts(key[order])
    many = np.diff(np.append(runs, len(key)))
    lefts = left[order]
    # a first look: windows that occur once, or always after the same byte, can't begin a repeat
    useful = (many > 1) & ((np.minimum.reduceat(lefts, runs) != np.maximum.reduceat(lefts, runs))
                           | (np.minimum.reduceat(lefts, runs) < 0))
    picked = order[np.repeat(useful, many)]
    lots = np.append(0, np.cumsum(many[useful])).tolist()
    del key, order, lefts, runs
    own = np.searchsorted(after, picked, side="right")
    start, before = picked - (after - windows)[own], left[picked]
    for s, e in zip(lots[:-1], lots[1:], strict=True):
        lot = [(strings[n][i:], b, n, i) for n, i, b in zip(
            own[s:e].tolist(), start[s:e].tolist(), before[s:e].tolist(), strict=True)]
        lot.sort()
        yield lot


Node = tuple[int, int, int, int, list[int]]


def interval_tree(lot: list[tuple[bytes, int, int, int]], rank: list, length: int) -> Iterator[Node]:
    """Stack scan over sorted suffixes: the intervals of a common prefix of ``length`` or more
    whose left bytes differ, inner before outer, as (common prefix, first suffix, last suffix,
    number of the suffix of least rank, those that are first in an inner interval only)."""
    stack: list[list] = []  # [common prefix, first suffix, left byte or -1, least, others]
    final = len(lot) - 1
    for i in range(final + 1):
        depth = _common(lot[i][0], lot[i + 1][0]) if i < final else 0
        first, same, least = i, lot[i][1], i
        while stack and stack[-1][0] > depth:
            value, first, before, other, lost = stack.pop()
            if rank[other] < rank[least]:
                other, least = least, other
            lost.append(other)
            same = before if before == same else -1
            if value >= length and same < 0:
                yield value, first, i, least, lost
        if stack and stack[-1][0] == depth:
            top = stack[-1]
            top[2] = top[2] if top[2] == same else -1
            if rank[least] < rank[top[3]]:
                top[3], least = least, top[3]
            top[4].append(least)
        elif depth:
            stack.append([depth, first, same, least, []])


def maximal_repeats(strings: list[bytes], group: np.ndarray, length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(repeat length, [(string number, start), ...]) of the maximal repeats of at least
    ``length`` bytes, with all occurrences, within each group of strings.

    A repeat is given out if it can't be made longer on either side: to the right since it is an
    interval of the common-prefix tree, to the left since the bytes before it differ (the start
    of a string differs from everything).
    """
    for lot in _suffix_groups(strings, group, length):
        for size, first, last, _, _ in interval_tree(lot, list(range(len(lot))), length):
            yield size, [(n, i) for _, _, n, i in lot[first : last + 1]]


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid
    return low


def _tree_marks(cut: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = (b.slice(i, CONTEXTS) for b in batches for i in range(0, b.num_rows, CONTEXTS))
        for part in sorted_groups(slices, "h", CONTEXTS):
            ids, low = part.column("doc_id").to_pylist(), part.column("low").to_pylist()
            out: set[tuple[int, int, int]] = set()
            for lot in _suffix_groups(part.column("context").to_pylist(), part.column("h").to_numpy().view(_U), length):
                places = [(ids[n], low[n] + i) for _, _, n, i in lot]
                for size, _, _, _, lost in interval_tree(lot, places, length):
                    out.update((*places[x], places[x][1] + size) for x in lost)
            d, s, e = np.array(list(out), np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(d), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], ["doc_id", "low", "high"])

    return cut.select("h", "doc_id", "low", "context").repartition("h").sortWithinPartitions("h").mapInArrow(
        run, "doc_id long, low int, high int")


def _window_marks(cut: DataFrame, length: int) -> DataFrame:
    """The same marks for anchors with very many differing contexts: every window by its hash,
    pre-aggregated to the first place of each before and joined back to all places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(hashlib.blake2b(x[i : i + length], digest_size=16).digest(), d, low + i, low + i + length)
                    for d, low, x in zip(batch.column("doc_id").to_pylist(), batch.column("low").to_pylist(),
                                         batch.column("context").to_pylist(), strict=True)
                    for i in range(len(x) - length + 1)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("w", "doc_id", "low", "high"), r, strict=True)) for r in rows],
                schema=pa.schema([("w", pa.binary()), ("doc_id", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]))

    windows = cut.select("doc_id", "low", "context").mapInArrow(run, "w binary, doc_id long, low int, high int")
    first = windows.groupBy("w").agg(F.min(F.struct("doc_id", "low")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return windows.join(first.select("w", "first"), "w").where("struct(doc_id, low) > first").select("doc_id", "low", "high")


def repeated_spans(docs: DataFrame, length: int = LENGTH, k: int = K, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): ``texts`` has every row with its own ``row_key`` in place of ``doc_id``, ``spans``
    (doc_id, low, high) the byte spans, by that key, that also occur earlier, overlapping ones included."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = row_keyed(docs, "keyed").withColumn("own_id", F.col("doc_id").cast("long")).withColumn("doc_id", F.col("row_key"))
    # no key is null; stated here, so that both joins by key share one exchange of the texts
    texts = rows.select("doc_id", "own_id", "text", *others).where("doc_id IS NOT NULL")
    marks = written(_classed(anchors(texts, length, k), hot), "marks")
    cut = _cut(texts, marks.where(f"contexts > 1 and contexts <= {hot}"))
    spans = marks.where("contexts = 0").select("doc_id", "low", "high").unionByName(_tree_marks(cut, length))
    if not marks.where(f"contexts > {hot}").isEmpty():
        spans = spans.unionByName(_window_marks(_cut(texts, marks.where(f"contexts > {hot}")), length))
    return texts, spans


def _joined(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as disjoint runs; runs that touch are one."""
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    first = np.flatnonzero(np.concatenate(([True], low[1:] > reach[:-1])))
    return low[first], reach[np.append(first[1:] - 1, len(low) - 1)]


def dedup(docs: DataFrame, length: int = LENGTH, k: int = K, hot: int = HOT, whole_characters: bool = False,
          keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, columns of ``keep``, n_bytes, n_removed, n_spans, kept) for each row of ``docs``: ``kept``
    is the rest of the bytes. With ``whole_characters`` removed runs are drawn in to whole characters first,
    so ``kept`` is valid UTF-8.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Every row is a document of its
    own: rows that share an id come in the order of their texts, rows without an id behind all others.
    So of repeated rows the first keeps its text. A null text counts as empty. A text shorter than
    ``length`` bytes is kept whole. An empty table gives an empty result.
    """
    texts, spans = repeated_spans(docs.select("doc_id", "text", *keep), length, k, hot)
    per_doc = spans.groupBy("doc_id").agg(F.collect_list(_span()).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = text_bytes(batch.column("text"))
            lists = batch.column("spans")
            flat, counts = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy()
            low, high = _unpacked(flat.to_numpy(zero_copy_only=False).astype(np.int64))
            after = np.cumsum(counts)
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for i, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                data = raw[s:e]
                runs = (np.zeros(0, np.int64),) * 2
                if counts[i]:
                    runs = _joined(low[after[i] - counts[i] : after[i]], high[after[i] - counts[i] : after[i]])
                    if whole_characters:
                        runs = _whole_characters(data, *runs)
                kept = _without(data, *runs)
                out["n_bytes"].append(e - s)
                out["n_removed"].append(e - s - len(kept))
                out["n_spans"].append(len(runs[0]))
                out["kept"].append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("own_id"), *(batch.column(c) for c in keep), *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
                 pa.array(out["kept"], pa.binary())], ["doc_id", *keep, *out])

    joined = texts.join(per_doc, "doc_id", "left")
    return joined.select("own_id", *keep, "text", "spans").mapInArrow(run, T.StructType([
        T.StructField("doc_id", T.LongType()), *(joined.schema[c] for c in keep),
        *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())]))


def _without(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> bytes:
    edges = [0, *np.stack([low, high], 1).ravel().tolist(), len(data)]
    return b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True))


def _whole_characters(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs drawn in so that no character is cut: a byte 10xxxxxx continues a character."""
    lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    low = lead[np.searchsorted(lead, low)]
    high = lead[np.searchsorted(lead, high, side="right") - 1]
    some = high > low
    return low[some], high[some]
