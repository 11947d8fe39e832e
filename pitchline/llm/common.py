"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.session import temporary_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back: cuts lineage and
    survives the loss of executors."""
    spark = df.sparkSession
    path = temporary_folder(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a ``row_key`` of its own for every row, in the order of ``doc_id``: the id itself where
    ids are unique, else a number that follows the id, then the text, null ids last."""
    ids = docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
    if ids.isEmpty():
        return docs.withColumn("row_key", F.col("doc_id").cast("long"))
    order = [F.col("doc_id").asc_nulls_last(), "text", *(c for c in docs.columns if c not in ("doc_id", "text"))]
    return written(docs.orderBy(*order).withColumn("row_key", F.monotonically_increasing_id()), name)


def process_cache(kind: str, key: Any, build: Callable[[], Any]) -> Any:
    """One object for each Python worker process, built on first use and anew when ``kind`` or ``key``
    changes; workers serve many tasks. ``key`` must tell different contents apart. Workers outlive the
    operator they were started for, so what the last one held goes before the next one's is built."""
    name = "pitchline_llm_process_cache"
    store = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if "held" not in store or store["held"][:2] != (kind, key):
        if store.pop("held", None) is not None:
            _give_back()
        store["held"] = (kind, key, build())
    return store["held"][2]


def _give_back() -> None:
    """Hands freed memory back to the system; the allocators would keep it for the process."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        return


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null counts as empty. No copy of the text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, raw


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return batch.column(column).fill_null("").to_pylist()


def sorted_groups(
    batches: Iterator[pa.RecordBatch], key: str, target_rows: int
) -> Iterator[pa.Table]:
    """Tables of whole groups of ``key`` from batches sorted by it, each of ``target_rows`` rows
    or more (fewer at the end): groups never straddle two tables."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < target_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys, keys[-1], side="left"))
        if last == 0 and len(held) > 1 and held[-2].column(key)[-1].as_py() == keys[-1]:
            continue  # the open group began in an earlier batch and may be alone there
        head = [*held[:-1], batch.slice(0, last)]
        if sum(b.num_rows for b in head):
            yield pa.Table.from_batches(head)
        held, rows = [batch.slice(last)], batch.num_rows - last
    if held:
        yield pa.Table.from_batches(held)


def group_starts(keys: np.ndarray) -> np.ndarray:
    """First index of every run of equal neighbours."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
