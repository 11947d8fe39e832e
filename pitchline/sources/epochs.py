"""Append-only epochs and the manifest that makes them visible.

Every landing run writes its rows under ``epoch=<n>`` of each dataset and touches nothing that was
landed before; a run that is repeated replaces its own epoch. Last it commits the manifest: one row
for each match that is complete in this epoch, that is, has rows in all three datasets and, where
the run knows how many there ought to be, all of them. Readers take each match from the newest epoch
the manifest names for it, so neither a crashed run nor a half-landed match is ever seen, and a
match that is landed again replaces its older rows at once and whole.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

col = F.col

DATASETS = ("events", "lineups", "matches")
MANIFEST = "match_id long, events long, lineups long, matches long"


def path_of(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = path_of(spark, path)
    return fs.exists(p)


def epochs_of(spark: SparkSession, path: str) -> list[int]:
    """Epochs whose folders lie below ``path``."""
    p, fs = path_of(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"epoch=(\d+)", n)))


def next_epoch(spark: SparkSession, root: str) -> int:
    """One more than any epoch a run has begun, crashed runs included."""
    return max([e for d in (*DATASETS, "manifest") for e in epochs_of(spark, f"{root}/{d}")], default=-1) + 1


def clear_epoch(spark: SparkSession, folder: str) -> None:
    """Takes out what a crashed try of the same epoch has left, unless the epoch was committed."""
    root, _, name = folder.rsplit("/", 2)
    if exists(spark, f"{root}/manifest/{name}/_SUCCESS"):
        raise ValueError(f"{name} was committed; land into a new epoch")
    p, fs = path_of(spark, folder)
    if fs.exists(p):
        fs.delete(p, True)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Every committed (epoch, match) with its numbers of rows."""
    if not epochs_of(spark, f"{root}/manifest"):
        return spark.createDataFrame([], MANIFEST + ", epoch int")
    return spark.read.schema(MANIFEST + ", epoch int").parquet(f"{root}/manifest")


def newest(spark: SparkSession, root: str) -> DataFrame:
    """(match_id, epoch): the epoch that counts for each complete match."""
    return manifest(spark, root).groupBy("match_id").agg(F.max("epoch").alias("epoch"))


def visible(rows: DataFrame, root: str) -> DataFrame:
    """Of rows with ``match_id`` and ``epoch`` those that count, without the epoch."""
    return rows.join(newest(rows.sparkSession, root), ["match_id", "epoch"], "left_semi").drop("epoch")


def commit(spark: SparkSession, root: str, epoch: int, counts: dict[str, DataFrame], expected: DataFrame | None = None) -> DataFrame:
    """Writes the epoch's manifest and returns its rows. ``counts`` has (match_id, rows) of each
    dataset as written; ``expected`` (match_id, dataset, rows) as they ought to be."""
    parts = [df.select("match_id", F.lit(name).alias("dataset"), "rows") for name, df in counts.items()]
    found = reduce(DataFrame.unionByName, parts)
    if expected is not None:
        wrong = found.join(expected.withColumnRenamed("rows", "due"), ["match_id", "dataset"], "full").where(~col("rows").eqNullSafe(col("due"))).where(
            col("due").isNotNull())
        found = found.join(wrong.select("match_id").distinct(), "match_id", "left_anti")
    per_match = found.groupBy("match_id").agg(*[F.sum(F.when(col("dataset") == d, col("rows"))).alias(d) for d in DATASETS])
    path = f"{root}/manifest/epoch={epoch}"
    per_match.where(" AND ".join(f"{d} > 0" for d in DATASETS)).write.mode("overwrite").parquet(path)
    return spark.read.schema(MANIFEST).parquet(path)
