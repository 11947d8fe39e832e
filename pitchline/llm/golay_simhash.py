"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into two 23-bit segments and one of 18 bits. The (23,12) binary Golay
code is perfect: every 23-bit word lies within 3 bits of exactly one codeword. A segment's keys
are the indices of all codewords within 4 bits of it, one or six of them. Two segments that
differ in at most 2 bits share a key: the codeword nearest to the word half-way between them is
within 3 + 1 bits of both.

Pigeonhole for at most 4 differing bits (e1 + e2 + e3 <= 4):

* e1 <= 2 and e2 <= 2: a key of segment 1 and a key of segment 2 agree together;
* e1 >= 3, hence e2 + e3 <= 1: a key of segment 2 and all of segment 3 agree, or all of segment 2;
* e2 >= 3: the same with segment 1.

Rows that share a key meet in one group and are verified on all 64 bits. A group returns only
spanning links, never all pairs; the result is the connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import group_starts, process_cache, sorted_groups, text_bytes, written
from pitchline.llm.components import components

MAX_BITS = 4
#: Fixed value: generator polynomial of the binary Golay code,
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: Fingerprints of one key that one task compares; larger groups are dealt out in block pairs.
BLOCK = 4096


def _code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parity by message, error patterns by syndrome padded to six, number of patterns)."""
    parity = np.arange(4096, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        parity = np.where(parity >> bit & 1, parity ^ (GENERATOR << (bit - 11)), parity)
    words = np.array([sum(1 << b for b in bits) for bits in _patterns()], dtype=np.int64)
    syndrome = parity[words >> 11] ^ (words & 0x7FF)
    order = np.argsort(syndrome, kind="stable")
    counts = np.bincount(syndrome, minlength=2048)
    table = np.zeros((2048, 6), dtype=np.int64)
    place = np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts)
    table[syndrome[order], place] = words[order]
    return parity, table, counts


def _patterns() -> list[tuple[int, ...]]:
    """Bit positions of every error pattern of weight 0 to 4 on 23 bits."""
    from itertools import combinations

    return [c for weight in range(5) for c in combinations(range(23), weight)]


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 23-bit words: (n x 6 codeword indices, n x 6 mask of those that count)."""
    parity, table, counts = process_cache("golay", None, _code_tables)
    syndrome = parity[words >> 11] ^ (words & 0x7FF)
    index = (words[:, None] ^ table[syndrome]) >> 11
    return index, np.arange(6)[None, :] < counts[syndrome][:, None]


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) of all keys of 64-bit fingerprints (uint64)."""
    a, b = (fp & 0x7FFFFF).astype(np.int64), (fp >> 23 & 0x7FFFFF).astype(np.int64)
    c = (fp >> 46).astype(np.int64)
    ka, ma = segment_keys(a)
    kb, mb = segment_keys(b)
    rows, keys = [], []

    def put(kind: int, value: np.ndarray, mask: np.ndarray) -> None:
        r, k = np.nonzero(mask)
        rows.append(r)
        keys.append(value[r, k] | kind << 48)

    both = (ka[:, :, None] << 12 | kb[:, None, :]).reshape(len(fp), 36)
    put(0, both, (ma[:, :, None] & mb[:, None, :]).reshape(len(fp), 36))
    put(1, ka << 18 | c[:, None], ma)
    put(2, a[:, None], np.ones((len(fp), 1), bool))
    put(3, kb << 18 | c[:, None], mb)
    put(4, b[:, None], np.ones((len(fp), 1), bool))
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority of the bits of the XXH64 (seed 42) of all word shingles, repeats included."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(flat, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: -shingle])).tolist()
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(flat[s:e], 42) for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)],
                      dtype=np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes), bitorder="little"), "little")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint of every text as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = text_bytes(batch.column("text"))
            fps = [fingerprint(raw[s:e].tobytes(), shingle)
                   for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _keyed(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                fp = part.column("fp").to_numpy(zero_copy_only=False)
                row, key = fuzzy_keys(fp.view(np.uint64))
                node = part.column("node").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(fp[row]), pa.array(node[row])], ["key", "fp", "node"])

    return classes.mapInArrow(run, "key long, fp long, node long")


def _spanning(fp: np.ndarray, node: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what lies within ``max_bits`` of each other: a search from each
    unvisited row, so at most n - 1 links."""
    links, left = [], np.arange(len(fp))
    while len(left) > 1:
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(fp[left] ^ fp[at]) <= max_bits
            found = left[near]
            links += [(int(node[at]), int(node[x])) for x in found]
            front += found.tolist()
            left = left[~near]
    return links


def _linked(keyed: DataFrame, max_bits: int, block: int) -> DataFrame:
    """Verified spanning links of every key. Keys of more than ``block`` rows are split: each row
    goes to one task for each pair of blocks its own block is part of."""
    hot = keyed.groupBy("key").count().where(F.col("count") > block).select(
        "key", F.ceil(F.col("count") / block).cast("int").alias("n"))
    n = F.coalesce("n", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), n).cast("int")
    dealt = keyed.join(hot, "key", "left").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), n - 1))).select(
        F.when(n == 1, F.col("key")).otherwise(
            F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).alias("key"), "fp", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_groups(batches, "key", 50_000):
            key = part.column("key").to_numpy()
            fp = part.column("fp").to_numpy().view(np.uint64)
            node = part.column("node").to_numpy()
            starts = group_starts(key)
            sizes = np.diff(np.append(starts, len(key)))
            links: set[tuple[int, int]] = set()
            two = starts[sizes == 2]
            close = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits]
            links.update(zip(node[close].tolist(), node[close + 1].tolist(), strict=True))
            for s, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                links.update(_spanning(fp[s : s + size], node[s : s + size], max_bits))
            u, v = np.array(sorted(links), np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or blank text has
    fingerprint zero and is linked like any other; rows with a null ``doc_id`` get a fingerprint
    and a null component. Exact copies share a fingerprint and are compared once; repeated rows
    give repeated results. ``max_bits`` is at most 4, which is what the keys guarantee.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be between 0 and {MAX_BITS}")
    fps = written(fingerprints(docs, shingle), "fingerprints")
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null")
    classes = written(classes, "classes")
    comp = components(_linked(_keyed(classes), max_bits, block))
    by_fp = classes.join(comp, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    out = fps.join(by_fp, "fp", "left")
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
