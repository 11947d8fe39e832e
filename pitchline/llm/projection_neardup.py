"""Near-duplicate vectors by counting collisions on many sorted one-dimensional projections.

Unit vectors are projected on random directions, each taken in both senses. A vector is posted
only where it lies furthest out: on its ``depth`` largest projections. There the tail is thin, so
a query-centred window holds few strangers, while a vector at the cosine in question stays within
the window. Two vectors collide on a projection if both are posted there and their values are
within ``width``; pairs with at least ``count`` collisions are verified by their cosine. ``count``
is calibrated: the largest for which simulated pairs at exactly the threshold reach the recall.
Projections are isotropic, so that holds for any data of that dimension.

A pair with ``count`` collisions has one among the first ``depth - count + 1`` postings of either
vector, in an order common to all. So vectors meet in the groups of those postings only, and a
pair counts in the group of its first collision alone: no pair moves between tasks. A group
returns, per vector, how many links it has there and the root of its local component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import group_starts, process_cache, sorted_groups, written
from pitchline.llm.components import components

DEPTH = 16
WIDTH = 1.0
RECALL = 0.999
#: Vectors of a projection that one task compares; larger groups are dealt out in block pairs.
BLOCK = 2048
#: Postings of a token in a group up to which its pairs are listed one shift at a time.
FEW = 32


def directions(count: int, dim: int) -> np.ndarray:
    """``count`` random directions, scaled so that projections of unit vectors have variance 1."""
    a = np.random.default_rng([2718, count, dim]).standard_normal((count, dim))
    return a * (np.sqrt(dim) / np.linalg.norm(a, axis=1, keepdims=True))


def postings(unit: np.ndarray, a: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, values), each row in the common order of tokens: the ``depth`` largest projections
    of every vector. Token 2j is direction j, 2j + 1 its opposite."""
    y = unit @ a.T
    size = np.abs(y)
    depth = min(depth, y.shape[1])
    top = np.argpartition(size, y.shape[1] - depth, axis=1)[:, y.shape[1] - depth :]
    token = 2 * top + (np.take_along_axis(y, top, 1) < 0)
    order = np.argsort(token, axis=1)
    return (np.take_along_axis(token, order, 1).astype(np.int32),
            np.take_along_axis(np.take_along_axis(size, top, 1), order, 1).astype(np.float32))


def values_at(unit: np.ndarray, a: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The values that postings have on their tokens, row by row: the same wherever a row goes."""
    return (np.einsum("ij,ikj->ik", unit, a[token >> 1]) * (1 - 2 * (token & 1))).astype(np.float32)


def _collisions(tx: np.ndarray, vx: np.ndarray, ty: np.ndarray, vy: np.ndarray, width: float) -> np.ndarray:
    """Pairs by depth: whether x's posting collides with one of y's."""
    hit = (tx[:, :, None] == ty[:, None, :]) & (np.abs(vx[:, :, None] - vy[:, None, :]) <= width)
    return hit.any(2)


def calibrated(count: int, dim: int, threshold: float, depth: int, width: float, recall: float) -> int:
    """The largest collision count that the share ``recall`` of pairs at the threshold reach."""
    rng = np.random.default_rng(31)
    x = rng.standard_normal((4000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.standard_normal(x.shape)
    u -= (u * x).sum(1, keepdims=True) * x
    norm = np.linalg.norm(u, axis=1, keepdims=True)
    if dim < 2:
        return 1
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * u / norm
    a = directions(count, dim)
    hits = _collisions(*postings(x, a, depth), *postings(y, a, depth), width).sum(1)
    return max(1, int(np.sort(hits)[int((1 - recall) * len(hits))]))


def _candidates(token: np.ndarray, value: np.ndarray, width: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x < y) of rows of a group that have ``least`` collisions or more. One-dimensional
    windows on each token's values."""
    n, depth = token.shape
    row = np.repeat(np.arange(n), depth)
    order = np.lexsort((row, token.ravel()))
    t, v, r = token.ravel()[order], value.ravel()[order], row[order]
    starts = group_starts(t)
    sizes = np.diff(np.append(starts, len(t)))
    small = np.repeat(sizes <= FEW, sizes)
    ts, vs, rs = t[small], v[small], r[small]
    keys = []
    for shift in range(1, min(FEW, int(sizes[sizes <= FEW].max(initial=1)))):
        hit = (ts[shift:] == ts[:-shift]) & (np.abs(vs[shift:] - vs[:-shift]) <= width)
        keys.append(rs[:-shift][hit] * n + rs[shift:][hit])
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    large = np.flatnonzero(sizes > FEW)
    if not len(large):
        pair, hits = np.unique(key, return_counts=True)
        pair = pair[hits >= least]
        return pair // n, pair % n
    counts = np.zeros((n, n), np.int16)  # at most 2 * BLOCK rows a group
    np.add.at(counts.reshape(-1), key, 1)
    for g in large.tolist():
        some = slice(starts[g], starts[g] + sizes[g])
        rows, values = r[some], v[some]
        counts[np.ix_(rows, rows)] += np.abs(values[:, None] - values[None, :]) <= width
    return np.nonzero(np.triu(counts >= least, 1))


def _local_roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        least = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, least)
        np.minimum.at(new, y, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _grouped(posted: DataFrame, threshold: float, count: int, width: float, block: int, projections: int, kind: str) -> DataFrame:
    """(node, links, root) of every group, for nodes that have links there."""
    hot = posted.groupBy("token").count().where(F.col("count") > block).select(
        "token", F.ceil(F.col("count") / block).cast("int").alias("n"))
    n = F.coalesce("n", F.lit(1))
    dealt = posted.join(hot, "token", "left").withColumn("own", F.pmod(F.xxhash64("node"), n).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), n - 1)))
    dealt = dealt.withColumn("key", F.when(n == 1, F.col("token").cast("long")).otherwise(
        F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")))).withColumn(
        "cross", F.least("own", "other") != F.greatest("own", "other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_groups(batches, "key", 2_000):
            part = part.combine_chunks()
            node, weight = part["node"].to_numpy(), part["weight"].to_numpy()
            own, cross, here = part["own"].to_numpy(), part["cross"].to_numpy(), part["token"].to_numpy()
            token = np.array([np.frombuffer(b, np.int16) for b in part["tokens"].to_pylist()]).astype(np.int32)
            unit = _unit(np.array([np.frombuffer(b, kind) for b in part["vector"].to_pylist()]))
            a = process_cache("directions", (projections, unit.shape[1]), lambda d=unit.shape[1]: directions(projections, d))
            value = values_at(unit, a, token)
            starts = group_starts(part["key"].to_numpy())
            out: list[tuple[np.ndarray, ...]] = []
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(node)], strict=True):
                t, v = token[s:e], value[s:e]
                x, y = _candidates(t, v, width, count)
                found = []
                for at in range(0, len(x), 20_000):
                    i, j = x[at : at + 20_000], y[at : at + 20_000]
                    close = np.einsum("ij,ij->i", unit[s:e][i], unit[s:e][j]) >= threshold
                    if cross[s]:
                        close &= own[s:e][i] != own[s:e][j]
                    i, j = i[close], j[close]
                    # the pair counts in the group of its first collision
                    first = np.argmax(_collisions(t[i], v[i], t[j], v[j], width), axis=1) if len(i) else i
                    here_first = t[i, first] == here[s] if len(i) else close[close]
                    found.append((i[here_first], j[here_first]))
                if not found:
                    continue
                i, j = (np.concatenate(z) for z in zip(*found, strict=True))
                if not len(i):
                    continue
                links = np.bincount(i, weight[s:e][j], e - s) + np.bincount(j, weight[s:e][i], e - s)
                order = np.argsort(node[s:e], kind="stable")  # roots are least nodes
                place = np.empty(e - s, np.int64)
                place[order] = np.arange(e - s)
                roots = node[s:e][order][_local_roots(e - s, place[i], place[j])][place]
                some = links > 0
                out.append((node[s:e][some], links[some].astype(np.int64), roots[some]))
            columns = [np.concatenate(z) for z in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(z) for z in columns], ["node", "links", "root"])

    sent = dealt.select("key", "token", "own", "cross", "node", "weight", "tokens", "vector")
    return sent.repartition("key").sortWithinPartitions("key").mapInArrow(run, "node long, links long, root long")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _posted(classes: DataFrame, count: int, projections: int, depth: int, kind: str) -> DataFrame:
    """(token, node, weight, tokens, vector): a row for each of a vector's first postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = np.array(part.column("embedding").to_pylist(), kind)
                a = process_cache("directions", (projections, x.shape[1]), lambda d=x.shape[1]: directions(projections, d))
                token, _ = postings(_unit(x), a, depth)
                used = max(1, token.shape[1] - count + 1)
                row = np.repeat(np.arange(len(x)), used)
                blobs = [pa.array([z.tobytes() for z in m], pa.binary()).take(pa.array(row)) for m in (token.astype(np.int16), x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token[:, :used].ravel()), part.column("node").take(pa.array(row)),
                     part.column("weight").take(pa.array(row)), *blobs], ["token", "node", "weight", "tokens", "vector"])

    return classes.select("embedding", "node", "weight").mapInArrow(
        run, "token int, node long, weight long, tokens binary, vector binary")


def usable(column: str = "embedding"):
    """True for vectors without null or non-finite components that aren't zero."""
    e = F.col(column)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def neardup(vectors: DataFrame, threshold: float = 0.9, depth: int = DEPTH, width: float = WIDTH, recall: float = RECALL,
            projections: int | None = None, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored. Vectors that are
    null, empty, zero or hold null or non-finite components link with nothing, and so do vectors
    of different lengths. Equal vectors are compared once, as one class. Of rows that share an id
    the one with the least vector counts. A null id takes no part: no links, null component. ``projections`` follows from the
    number of vectors unless given.
    """
    if projections is not None and not 0 < projections < 1 << 14:
        raise ValueError("projections must lie between 1 and 16383")
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding")).where("vec_id is not null")
    members = written(rows.where(usable()).distinct().groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    # a zero may have either sign: adding zero gives the positive one, so that equal vectors have equal keys
    members = members.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0).cast("float")))
    classes = written(members.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight")), "classes")
    dims = {r.d: r.n for r in classes.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()}
    kind = "<f4" if rows.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    found = None
    for dim, n in sorted(dims.items()):
        m = projections or int(min(4096, max(256, 2 ** np.ceil(np.log2(4 * np.sqrt(n))))))
        count = calibrated(m, dim, threshold, depth, width, recall)
        one = _grouped(_posted(classes.where(F.size("embedding") == dim), count, m, depth, kind), threshold, count, width, block, m, kind)
        found = one if found is None else found.unionByName(one)
    every = vectors.select(F.col("vec_id").cast("long"))
    if found is None:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.col("vec_id").isNotNull().alias("kept"))
    found = written(found, "links")
    comp = components(found.where("node <> root"), "node", "root")
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    by_class = classes.join(degree, "node", "left").join(comp, "node", "left").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"))
    linked = members.join(by_class, "embedding").select("vec_id", "n_links", "component_id")
    return every.join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id").isNotNull() & (F.coalesce("component_id", "vec_id") == F.col("vec_id"))).alias("kept"))
