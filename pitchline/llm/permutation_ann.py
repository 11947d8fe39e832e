"""Nearest neighbours by a permutation index.

A vector is represented by the order in which it sees a fixed set of pivots, nearest first. Each
pivot has an inverted file: the vectors by the position they give that pivot. A query opens the
files of its pivots and reads, in each, the positions within ``window`` of its own; every entry
read lowers the vector's footrule distance (the sum of position differences, each at most
``window``) from its maximum. The vectors of least footrule are reranked by their cosine.

The index is cut into blocks of about ``block_rows`` vectors by a hash of the id, each with its
inverted files; query blocks meet index blocks. From each block come a query's ``k`` best, from
those the best of all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import written
from pitchline.llm.projection_neardup import usable

#: PIVOTS * WINDOW must stay below 2**15.
PIVOTS = 128
WINDOW = 64
#: Distinct vectors among which the pivots are chosen.
SAMPLE = 2048
#: Share of a block's vectors that is reranked, and the least number.
SHARE, LEAST = 0.12, 600
BLOCK_ROWS = 8192
QUERY_ROWS = 1024


def pivots(vectors: DataFrame, count: int, sample: int = SAMPLE) -> np.ndarray:
    """Up to ``count`` unit vectors that lie far apart: out of a bounded sample, chosen by a hash of
    the components, always the one whose angle to the lines of those taken is largest. A group of
    near copies, however large, gives one pivot and not its share of them."""
    rows = vectors.select("embedding").distinct().orderBy(F.xxhash64("embedding"), "embedding").limit(sample).collect()
    x = np.array([r.embedding for r in rows], np.float64)
    if not len(x):
        return x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    taken = [0]
    near = np.abs(x @ x[0])
    while len(taken) < min(count, len(x)):
        near[taken[-1]] = np.inf
        taken.append(int(np.argmin(near)))
        near = np.maximum(near, np.abs(x @ x[taken[-1]]))
    return x[taken]


def positions(x: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    """For each vector the position of every pivot in its order of pivots, nearest first."""
    order = np.argsort(-(x @ pivot.T), axis=1, kind="stable")
    out = np.empty(order.shape, np.int16)
    np.put_along_axis(out, order, np.broadcast_to(np.arange(order.shape[1], dtype=np.int16), order.shape), 1)
    return out


class Block:
    """Inverted files of a block: for each pivot the rows by the position they give it."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivot: np.ndarray, window: int) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.norm = np.sqrt((self.x * self.x).sum(1))
        self.window = window
        place = positions(self.x, pivot)
        files = np.argsort(place, axis=0, kind="stable")
        self.rows = np.ascontiguousarray(files.T)
        self.places = np.ascontiguousarray(np.take_along_axis(place, files, 0).T)
        steps = np.arange(len(pivot) + 1)
        self.starts = np.array([np.searchsorted(p, steps) for p in self.places])

    def gains(self, place: np.ndarray) -> np.ndarray:
        """By how much each row's footrule distance to a query lies below its maximum."""
        out = np.zeros(len(self.ids), np.int16)
        last = len(place)
        for pivot, p in enumerate(place.tolist()):
            low, high = self.starts[pivot][max(0, p - self.window)], self.starts[pivot][min(last, p + self.window + 1)]
            gain = self.places[pivot, low:high] - np.int16(p)
            np.abs(gain, out=gain)
            np.subtract(np.int16(self.window), gain, out=gain)
            out[self.rows[pivot, low:high]] += gain
        return out

    def nearest(self, query_id: int, q: np.ndarray, place: np.ndarray, k: int, share: float, least: int) -> list[tuple[int, float]]:
        """The ``k`` best of the reranked rows: (id, cosine), ties to the smaller id."""
        n = min(len(self.ids), max(least, int(np.ceil(share * len(self.ids)))))
        some = np.argsort(-self.gains(place), kind="stable")[: n + 1]  # ids ascend: ties to the smaller
        some = some[self.ids[some] != query_id]
        cosine = (self.x[some] @ q) / (self.norm[some] * np.sqrt(q @ q))
        best = np.lexsort((self.ids[some], -cosine))[:k]
        return [(int(self.ids[some[i]]), float(cosine[i])) for i in best]


def search(vectors: DataFrame, query: Column, k: int = 5, pivot_count: int = PIVOTS, window: int = WINDOW, share: float = SHARE,
           least: int = LEAST, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows nearest by cosine to each row for which
    ``query`` holds, other than itself; all others if there are fewer.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored. Rows whose id is
    null and vectors that are null, empty, zero or hold null or non-finite components take no
    part, as query or candidate; nor do vectors of a length other than a query's. Of rows that
    share an id the one with the least vector counts.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding")).where("vec_id is not null").where(usable())
    rows = written(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    sizes = {r.d: r.n for r in rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()}
    found = None
    for dim, n in sorted(sizes.items()):
        one = _searched(rows.where(F.size("embedding") == dim), query, n, k, pivot_count, window, share, least, block_rows, query_rows)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = found.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, k).alias("best"))  # k for each index block at most
    return best.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.less")).alias("score"))


def _searched(rows: DataFrame, query: Column, n: int, k: int, pivot_count: int, window: int, share: float, least: int,
              block_rows: int, query_rows: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(pivots(rows, pivot_count))  # bounded by pivot_count
    asked = rows.where(query)
    blocks, lots = max(1, -(-n // block_rows)), max(1, -(-asked.count() // query_rows))

    def cut(df: DataFrame, mine: str, parts: int, other: str, others: int) -> DataFrame:
        return df.withColumn(mine, F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        pivot = sent.value
        out: list[tuple[int, int, float]] = []
        if index.num_rows and queries.num_rows:
            x, q = (np.array(t["embedding"].to_pylist(), np.float64) for t in (index, queries))
            block = Block(index["vec_id"].to_numpy(), x, pivot, window)
            for name, vector, place in zip(queries["vec_id"].to_pylist(), q, positions(q, pivot), strict=True):
                out += [(name, i, c) for i, c in block.nearest(name, vector, place, k, share, least)]
        return pa.table({"query_id": pa.array([o[0] for o in out], pa.int64()), "vec_id": pa.array([o[1] for o in out], pa.int64()),
                         "score": pa.array([o[2] for o in out], pa.float64())})

    left = cut(rows, "block", blocks, "lot", lots).groupBy("block", "lot")
    right = cut(asked, "lot", lots, "block", blocks).groupBy("block", "lot")
    return left.cogroup(right).applyInArrow(run, "query_id long, vec_id long, score double")
