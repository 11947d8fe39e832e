"""Registered query for the streaming incremental landing."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchline.plans.catalog import query
from pitchline.session import ROWS_PER_TASK, temporary_folder
from pitchline.sources.warehouse import silver_tables
from pitchline.streaming import landing

col = F.col


@query("stream_incremental_landing")
def q_stream_incremental_landing(spark, sf):
    """Two drops of raw event files -- first the 2022 matches, then ALL matches again -- are
    landed by two scheduled streaming runs; every event must be landed exactly once."""
    base = temporary_folder(spark, "stream")
    incoming, root, ckpt = f"{base}/incoming", f"{base}/landed", f"{base}/checkpoint"
    ev = silver_tables(spark, sf)["events"].drop("ts")
    times = -(-ev.count() // (4 * ROWS_PER_TASK)) or 1  # files follow the rows, batches stay as many
    # matches are spread over the files of a drop and the files over several batches
    ev.where(col("season") == 2022).repartition(4 * times, "event_id").write.parquet(f"{incoming}/drop=1")
    q = landing.start_landing(spark, f"{incoming}/drop=1", ev.schema, root, ckpt, files_per_batch=3 * times)
    q.awaitTermination()
    ev.repartition(4 * times, "event_id").write.parquet(f"{incoming}/drop=2")
    q = landing.start_landing(spark, f"{incoming}/drop=*", ev.schema, root, ckpt, files_per_batch=3 * times)
    q.awaitTermination()
    landed = landing.read_landed(spark, root)
    return (landed.groupBy("competition", "season")
            .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_id").alias("n_distinct_events"),
                 F.count_distinct("match_id").alias("n_matches")))
