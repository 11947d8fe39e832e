"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every pitchline job relies on. ANSI mode stays on (Spark 4 default) so that bad casts
# and division by zero fail loudly; every helper in ``functions.exprs`` is written for it.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast only after AQE has measured it below this size at runtime;
    # larger sides stay sort-merge / shuffled-hash joins.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark 4 records the Python call site of every API call (a JVM round trip each) for
    # error messages; plan construction is several times faster without it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # reliable checkpoints of per-query intermediates are deleted once no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # file splits and post-shuffle partitions sized for executor memory; AQE coalesces small ones
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pitchline", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with pitchline's settings.

    On a cluster, ``master`` stays None and the launcher decides. Locally, pass e.g. ``local[8]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Rows of a task that sorts or writes whole event rows. Files are packed into tasks by their bytes,
#: of which a compressed event has a dozen, so a task's memory would grow with the input.
ROWS_PER_TASK = 1 << 18


def dealt(rows: DataFrame, count: int, order: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``count`` rows dealt out by ranges of ``order``, ``rows_per_task`` to a task; ``order`` must tell
    rows apart. Rows that one task may hold stay where they are."""
    tasks = -(-count // rows_per_task)
    return rows if tasks <= 1 else rows.repartitionByRange(tasks, *order)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The cluster names it; one is made only where it is unset and the master is local, as in tests.
    (A core config cannot be changed through ``spark.conf`` at runtime, so the fallback is set on
    the SparkContext only.)
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="pitchline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def shared_scratch(spark: SparkSession, name: str) -> str:
    """A folder for written intermediate tables, under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


_TEMPORARY: list[tuple[SparkSession, str]] = []


def temporary_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared location for tables that only this application reads; it is
    removed when the application's driver ends."""
    path = shared_scratch(spark, f"{name}/{uuid.uuid4().hex}")
    if not _TEMPORARY:
        atexit.register(_remove_temporary)
    _TEMPORARY.append((spark, path))
    return path


def _remove_temporary() -> None:
    for spark, path in _TEMPORARY:
        try:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is gone: nothing left to ask
            return
    _TEMPORARY.clear()
