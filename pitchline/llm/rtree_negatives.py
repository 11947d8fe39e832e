"""Hard negatives by STR-packed R-trees.

Vectors become whole numbers. Sorted by label and first component they are cut into blocks of
bounded size, each of one label, and every block is packed by sort-tile-recursive into an R-tree:
rows are cut into slabs along the component of widest range, each slab along the next, until a slab
is one leaf; parents hold neighbouring nodes. A node's minimum bounding box gives an interval for
each component's part of an inner product and, summed, bounds for all scores inside.

A search keeps the nodes still to be opened in a queue, highest upper bound first. Nodes are passed
over whose bounds lie outside every wanted score window or strictly below a full window's kth score.

Anchors look for their positives in their own block first; that kth score and the box of a whole
block tell which other blocks an anchor is sent to. Blocks and anchors meet in bounded lots, and
of each block an anchor takes along ``k`` rows a window at most.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator
from heapq import heappop, heappush
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.llm.common import written

#: Rows of a leaf, children of a node.
LEAF, FAN = 64, 8
#: Numbers in a block: 16,384 vectors of 64 components.
BLOCK_VALUES = 1 << 20
#: Anchors, and boxes of blocks, that are worked on together.
LOT = 4096
#: Anchors whose bounds are worked out together.
STEP = 256

_LONG = 2**63 - 1


def str_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """Rows of ``x`` in the order of sort-tile-recursive: every ``leaf`` of them make a leaf."""
    axes = np.argsort(-(x.max(0) - x.min(0)), kind="stable") if len(x) else np.zeros(0, np.int64)
    out: list[np.ndarray] = []
    todo = [(np.arange(len(x)), 0)]
    while todo:
        rows, axis = todo.pop()
        pages = -(-len(rows) // leaf)
        if pages <= 1 or axis == len(axes):
            out.append(rows)
            continue
        slabs = int(np.ceil(round(pages ** (1 / (len(axes) - axis)), 9)))
        size = leaf * -(-pages // slabs)
        rows = rows[np.argsort(x[rows, axes[axis]], kind="stable")]
        todo += [(rows[at : at + size], axis + 1) for at in range(0, len(rows), size)][::-1]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


class Wanted:
    """The best ``k`` scores from ``floor`` to ``cap``, ties to the smaller id."""

    def __init__(self, k: int, floor: float = -np.inf, cap: float = np.inf) -> None:
        self.k, self.cap, self.best = k, cap, []
        self.bar = floor if k else np.inf  # what a score has to reach

    def offer(self, scores: list, ids: list[int]) -> None:
        for score, i in zip(scores, ids, strict=True):
            if self.bar <= score <= self.cap:
                insort(self.best, (-score, i))
                if len(self.best) >= self.k:
                    del self.best[self.k :]
                    self.bar = -self.best[-1][0]


class Tree:
    """R-tree over rows that lie in the order of ``str_order``."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> None:
        self.x, self.ids, self.leaf, self.fan = x, ids, leaf, fan
        low, high, step = x, x, leaf
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while not self.levels or len(low) > 1:
            starts = np.arange(0, len(low), step)
            low, high = np.minimum.reduceat(low, starts, axis=0), np.maximum.reduceat(high, starts, axis=0)
            self.levels.append((low, high))
            step = fan

    def search(self, q: np.ndarray, up: list[list], low: list[list], wanted: list[Wanted], skip: int | None = None) -> int:
        """Offers to ``wanted`` all rows that count; returns the number of leaves opened."""
        top = len(self.levels) - 1
        queue: list[tuple[Any, int, int]] = [(-up[top][0], top, 0)]
        opened = 0
        while queue:
            bound, level, node = heappop(queue)
            need = min(w.bar for w in wanted)
            if -bound < need:
                break
            if level:
                ups, lows = up[level - 1], low[level - 1]
                for child in range(node * self.fan, min((node + 1) * self.fan, len(ups))):
                    if any(w.bar <= ups[child] and lows[child] <= w.cap for w in wanted):
                        heappush(queue, (-ups[child], level - 1, child))
                continue
            opened += 1
            rows = slice(node * self.leaf, (node + 1) * self.leaf)
            scores, ids = self.x[rows] @ q, self.ids[rows]
            some = (scores >= need) & (scores <= max(w.cap for w in wanted))
            if skip is not None:
                some &= ids != skip
            if some.any():
                scores, ids = scores[some].tolist(), ids[some].tolist()
                for w in wanted:
                    w.offer(scores, ids)
        return opened


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(upper, lower) bounds of the inner products of each row of ``q`` with what lies in each box."""
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    return plus @ high.T + minus @ low.T, plus @ low.T + minus @ high.T


def whole_numbers(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are where doubles hold every inner product exactly, otherwise as Python's integers."""
    reach = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if reach < 2**53:
        return a, b
    return tuple(np.array([int(v) for v in x.ravel()], object).reshape(x.shape) for x in (a, b))


def searched(x: np.ndarray, ids: np.ndarray, q: np.ndarray, wanted: list[list[Wanted]], skip: list[int] | None = None) -> None:
    """Best-first searches of a block for each row of ``q``."""
    x, q = whole_numbers(x, q)
    tree = Tree(x, ids)
    for at in range(0, len(q), STEP):
        both = [bounds(q[at : at + STEP], *level) for level in tree.levels]
        ups, lows = [b[0].tolist() for b in both], [b[1].tolist() for b in both]
        for i in range(min(STEP, len(q) - at)):
            if wanted[at + i]:
                tree.search(q[at + i], [u[i] for u in ups], [d[i] for d in lows], wanted[at + i], skip[at + i] if skip else None)


def _numbers(packed: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), dim)


def _long(score: Any) -> int:
    return max(-_LONG - 1, min(_LONG, int(score)))


_INDEX = "block long, label long, dim int, low binary, high binary, ids binary, asked binary, x binary"


def index(rows: DataFrame, scale: float) -> DataFrame:
    """One row for each block: its box and its vectors in the order of its R-tree."""
    values = rows.agg(F.sum(F.size("embedding") + 1)).first()[0] or 1
    order = ["dim", "label", F.get("embedding", F.lit(0)), "vec_id"]
    dealt = rows.withColumn("dim", F.size("embedding")).repartitionByRange(
        max(1, -(-values // BLOCK_VALUES)), *order).sortWithinPartitions(*order)

    def block(key: tuple[int, int], x: np.ndarray, ids: np.ndarray, asked: np.ndarray) -> pa.RecordBatch:
        order = str_order(x, LEAF)
        x, ids, asked = x[order], ids[order], asked[order]
        cells = [int(ids.min()), key[1], key[0], x.min(0).tobytes(), x.max(0).tobytes(), ids.tobytes(), asked.tobytes(), x.tobytes()]
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, kinds, strict=True)],
                                          ["block", "label", "dim", "low", "high", "ids", "asked", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        key, count = (0, 0), 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal held, count
            if held:
                yield block(key, *(np.concatenate(parts) for parts in zip(*held, strict=True)))
            held, count = [], 0

        for batch in batches:
            dims, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "label"))
            ids, asked = batch.column("vec_id").to_numpy(), batch.column("asked").to_numpy(zero_copy_only=False).astype(np.uint8)
            flat, ends = batch.column("embedding").flatten().to_numpy(zero_copy_only=False), np.cumsum(dims, dtype=np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], (dims[1:] != dims[:-1]) | (labels[1:] != labels[:-1])))) if len(dims) else []
            for a, z in zip(cuts, [*cuts[1:], len(dims)], strict=True):
                mine = (int(dims[a]), int(labels[a]))
                if mine != key:
                    yield from out()
                    key = mine
                size = max(1, BLOCK_VALUES // max(1, mine[0]))
                while a < z:
                    e = min(z, a + size - count)
                    x = flat[ends[a] - mine[0] : ends[e - 1]].astype(np.float64).reshape(e - a, mine[0])
                    held.append((np.floor(scale * x), ids[a:e], asked[a:e]))
                    count, a = count + e - a, e
                    if count == size:
                        yield from out()
        yield from out()

    return dealt.select("vec_id", F.col("label").cast("long"), "dim", "asked", "embedding").mapInArrow(run, _INDEX)


_ANCHOR = "anchor_id long, label long, dim int, home long, q binary, near array<struct<id: long, score: long>>"


def _home(index_: DataFrame, k: int) -> DataFrame:
    """Every anchor with the best ``k`` of its own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                r = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
                ids = np.frombuffer(r["ids"], np.int64)
                mine = np.flatnonzero(np.frombuffer(r["asked"], np.uint8))
                if not len(mine):
                    continue
                x = np.frombuffer(r["x"], "<f8").reshape(len(ids), r["dim"])
                wanted = [[Wanted(k)] for _ in mine]
                searched(x, ids, x[mine], wanted, ids[mine].tolist())
                rows = [{"anchor_id": i, "label": r["label"], "dim": r["dim"], "home": r["block"], "q": q.tobytes(),
                         "near": [{"id": b, "score": _long(-s)} for s, b in w[0].best]}
                        for i, q, w in zip(ids[mine].tolist(), x[mine], wanted, strict=True)]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([
                    ("anchor_id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("home", pa.int64()), ("q", pa.binary()),
                    ("near", pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())])))]))

    return index_.select("block", "label", "dim", "ids", "asked", "x").mapInArrow(run, _ANCHOR)


def _cells(index_: DataFrame, anchors: DataFrame, other_label: bool, spans: Any) -> DataFrame:
    """(block, lot and the anchors' columns) for every block that may hold rows an anchor wants:
    boxes and anchors meet in lots. ``spans`` gives the [floor, cap] pairs of an anchor row."""
    boxes = index_.select("block", "label", "dim", "low", "high")
    lots, shelves = max(1, -(-anchors.count() // LOT)), max(1, -(-boxes.count() // LOT))

    def dealt(df: DataFrame, key: str, mine: str, parts: int, other: str, others: int) -> DataFrame:
        return df.withColumn(mine, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    schema = anchors.schema
    fields = ["block", "lot", *schema.names]

    def run(box: pa.Table, asks: pa.Table) -> pa.Table:
        picked: list[tuple[int, np.ndarray]] = []
        dims, of = np.array(box["dim"].to_pylist(), np.int64), np.array(asks["dim"].to_pylist(), np.int64)
        labels, names = np.array(box["label"].to_pylist(), np.int64), np.array(asks["label"].to_pylist(), np.int64)
        limits = [spans(r) for r in asks.drop_columns(["q"]).to_pylist()]
        home = np.array(asks["home"].to_pylist(), np.int64)
        for dim in np.unique(dims).tolist():
            here, there = np.flatnonzero(dims == dim), np.flatnonzero(of == dim)
            if not len(there):
                continue
            q = _numbers([asks["q"][int(i)].as_py() for i in there], dim)
            low, high = (_numbers([box[c][int(i)].as_py() for i in here], dim) for c in ("low", "high"))
            both, q = whole_numbers(np.concatenate([low, high]), q)
            up, down = bounds(q, both[: len(here)], both[len(here) :])
            for n, i in enumerate(there.tolist()):
                fits = np.zeros(len(here), bool)
                for floor, cap in limits[i]:
                    fits |= (up[n] >= floor).astype(bool) & (down[n] <= cap).astype(bool)
                fits &= (labels[here] != names[i]) if other_label else (labels[here] == names[i])
                blocks = np.array(box["block"].to_pylist(), np.int64)[here[fits]]
                picked.append((i, blocks[blocks != home[i]]))
        rows = asks.take(pa.array([i for i, b in picked for _ in range(len(b))], pa.int64()))
        blocks = np.concatenate([b for _, b in picked]) if picked else np.zeros(0, np.int64)
        return rows.append_column("block", pa.array(blocks, pa.int64())).select(fields)

    left = dealt(boxes, "block", "shelf", shelves, "lot", lots).groupBy("shelf", "lot")
    right = dealt(anchors, "anchor_id", "lot", lots, "shelf", shelves).groupBy("shelf", "lot")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return left.cogroup(right).applyInArrow(run, f"block long, lot int, {types}")


def _found(index_: DataFrame, cells: DataFrame, wishes: Any) -> DataFrame:
    """(anchor_id, wish, id, score): what each anchor wants of each block it is sent to. ``wishes``
    makes the list of ``Wanted`` of an anchor row."""
    visits = cells.select(F.col("block").alias("to"), F.col("lot").alias("by")).distinct()
    held = index_.join(visits, F.col("block") == F.col("to")).select("block", F.col("by").alias("lot"), "dim", "ids", "x")

    def run(blocks: pa.Table, asks: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if blocks.num_rows and asks.num_rows:
            r = {c: blocks[c][0].as_py() for c in ("dim", "ids", "x")}
            ids = np.frombuffer(r["ids"], np.int64)
            rows = asks.drop_columns(["q"]).to_pylist()
            wanted = [wishes(a) for a in rows]
            searched(np.frombuffer(r["x"], "<f8").reshape(len(ids), r["dim"]), ids, _numbers(asks["q"].to_pylist(), r["dim"]), wanted)
            out = [(a["anchor_id"], n, i, _long(-s)) for a, some in zip(rows, wanted, strict=True) for n, w in enumerate(some) for s, i in w.best]
        return pa.table([pa.array([o[c] for o in out], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                        ["anchor_id", "wish", "id", "score"])

    return held.groupBy("block", "lot").cogroup(cells.groupBy("block", "lot")).applyInArrow(
        run, "anchor_id long, wish int, id long, score long")


def _first(df: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return df.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Each component x counts as floor(``scale`` * x), a score is the integer inner product with an
    anchor, one of the rows for which ``anchor`` holds; higher scores come first, ties by smaller
    id. An anchor's positives are its first ``positives`` other rows of the same label. For each of
    them come the first ``negatives`` rows of other labels whose score is from ``low`` to ``high``
    percent of the positive's; fewer if there are fewer, so perhaps none.

    ``vectors`` needs ``vec_id``, ``label`` and ``embedding``; other columns are ignored. Rows whose
    id, label or vector is null or whose vector holds null or non-finite components take no part;
    vectors of different lengths never meet; those without components score 0. Of rows that share an
    id the one with the least label, then vector counts. Scores are exact; beyond the range of a long
    they are drawn in to its ends, and a positive's window follows from the score so drawn in. An empty
    table gives an empty result.
    """
    parts = F.col("embedding")
    sound = parts.isNotNull() & ~F.exists(parts, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long").alias("label"), "embedding").where(
        "vec_id IS NOT NULL AND label IS NOT NULL").where(sound)
    rows = written(rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("r")).select(
        "vec_id", "r.label", "r.embedding").withColumn("asked", F.coalesce(anchor, F.lit(False))), "vectors")
    trees = written(index(rows, scale), "rtree")
    home = written(_home(trees, positives), "anchors")

    def open_span(a: dict) -> list[tuple[float, float]]:
        return [(a["near"][-1]["score"] if len(a["near"]) >= positives else -np.inf, np.inf)]

    cells = written(_cells(trees, home, False, open_span), "cells")
    best = _found(trees, cells, lambda a: [Wanted(positives, *open_span(a)[0])]).drop("wish").unionByName(
        home.select("anchor_id", F.explode("near").alias("p")).select("anchor_id", "p.id", "p.score"))
    chosen = _first(best, ["anchor_id"], positives, "at").groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "id", "score"))).alias("chosen"))  # ``positives`` at most
    asks = written(home.drop("near").join(chosen, "anchor_id"), "windows")

    def spans(a: dict) -> list[tuple[int, int]]:
        return [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in a["chosen"]]

    def windows(a: dict) -> list[Wanted]:
        return [Wanted(negatives, floor, cap) for floor, cap in spans(a)]

    cells = written(_cells(trees, asks, True, spans), "cells")
    hard = _first(_found(trees, cells, windows), ["anchor_id", "wish"], negatives, "rank")
    return hard.join(asks.select("anchor_id", "chosen"), "anchor_id").select(
        "anchor_id", F.get("chosen", F.col("wish")).alias("p"), F.col("rank").cast("int").alias("rank"), "id", "score").select(
        "anchor_id", F.col("p.id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))
