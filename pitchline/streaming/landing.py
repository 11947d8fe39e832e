"""Incremental, idempotent landing of new matches with Structured Streaming.

The original loader re-runs over all matches and skips those already landed. Here the raw event
files dropped into an incoming folder are a streaming file source: the checkpoint records which
files were processed (each file exactly once), and every micro-batch

1. puts rows without a match or event id aside under ``refused/epoch=<batch id>`` with the reason:
   nothing tells whether they were met before;
2. drops the events it holds twice and those that EARLIER batches landed, by match and event id, so
   an event that arrives again in a later drop is not landed twice, while a match whose files are
   spread over any number of batches arrives whole;
3. writes the new events under ``epoch=<batch id>`` with overwrite, so a retried batch replaces
   its own output instead of duplicating it;
4. writes the ledger, one row per match of the batch, from the events it has just written.

The ledger tells which matches have been met before, and in which epochs: only those epochs' folders
are read for the comparison, so a batch of new matches compares with nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchline.session import ROWS_PER_TASK

col = F.col


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _landed(batch: DataFrame, root: str, before_epoch: int) -> DataFrame | None:
    """(match_id, event_id) of earlier batches, for the batch's matches that the ledger has from them."""
    spark = batch.sparkSession
    if before_epoch == 0 or not _exists(spark, f"{root}/ledger") or not _exists(spark, f"{root}/events"):
        return None
    ledger = spark.read.parquet(f"{root}/ledger").where(col("epoch") < before_epoch)
    met = ledger.join(batch.select("match_id").distinct(), "match_id", "left_semi")
    where = [r.epoch for r in met.select("epoch").distinct().collect()]  # one number a batch at most
    if not where:
        return None
    old = spark.read.parquet(f"{root}/events").where(col("epoch").isin(where)).select("epoch", "match_id", "event_id")
    return old.join(met, ["epoch", "match_id"], "left_semi").select("match_id", "event_id")


def land_batch(batch: DataFrame, epoch_id: int, root: str, partitions=("competition", "season")) -> None:
    """One micro-batch: put rows without ids aside, land the events that no earlier batch has
    landed, once each, then the ledger rows of their matches, all under ``epoch=<id>`` (overwrite:
    a retry replaces its own)."""
    spark = batch.sparkSession
    why = F.when(col("match_id").isNull(), "missing match_id").when(col("event_id").isNull(), "missing event_id")
    batch.withColumn("reason", why).where("reason IS NOT NULL").write.mode("overwrite").parquet(f"{root}/refused/epoch={epoch_id}")
    key = ["match_id", "event_id"]
    tasks = -(-batch.count() // ROWS_PER_TASK)  # footers have the count
    known = batch.dropna(subset=key).repartition(max(1, tasks), *key)  # a nearly unique key, so no hot partition
    new = known.dropDuplicates(key)  # sorts whole rows: after the shuffle, which bounds them, and not before it too
    landed = _landed(batch, root, epoch_id)
    if landed is not None:
        new = new.join(landed, key, "left_anti").select(*batch.columns)
    events = f"{root}/events/epoch={epoch_id}"
    new.write.mode("overwrite").partitionBy(*partitions).parquet(events)
    written = spark.read.schema(batch.schema).parquet(events)
    written.select("match_id").distinct().write.mode("overwrite").parquet(f"{root}/ledger/epoch={epoch_id}")


def start_landing(spark: SparkSession, incoming: str, schema, root: str, checkpoint: str,
                  files_per_batch: int = 64, available_now: bool = True) -> StreamingQuery:
    """Stream raw event files from ``incoming`` into ``root``; ``available_now`` processes what is
    there and stops (a scheduled incremental run), otherwise it keeps running."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(incoming))
    writer = (stream.writeStream.foreachBatch(lambda b, e: land_batch(b, e, root))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/events")


def read_refused(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/refused")
