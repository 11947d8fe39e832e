"""Materialised Silver tables, built once per input and read by every mart.

The SQL original materialises its staging models as tables and builds the marts on them. Here the
four Silver tables (events, matches, competitions, lineups) derived from the raw ``events`` table
are written once as Parquet under the shared checkpoint folder, keyed by the input's files (path,
size, modification time) and the version of the code, and then read by every query. Marts therefore scan a plain columnar table
(JSON parsing and the football mapping run once, not once per mart), filters and column pruning
reach that scan, and a lost executor re-reads files instead of replaying the derivation.

Layout: events partitioned by (competition, season) and sorted by match inside each file, so
Parquet row-group statistics stay selective for match filters (a test reads the files).
"""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.operators import quality as dq
from pitchline.session import dealt, shared_scratch
from pitchline.sources import bronze as br
from pitchline.sources import fb as fbsrc
from pitchline.sources import silver as sv
from pitchline.sources.constraints import MARTS, SPECS

SILVER = ("events", "matches", "competitions", "lineups")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


@lru_cache(maxsize=1)
def _code_version() -> str:
    """Hash of the package's source: tables of another version of the code are not served."""
    digest = hashlib.sha1()
    for file in sorted(Path(__file__).resolve().parents[1].rglob("*.py")):
        digest.update(file.read_bytes())
    return digest.hexdigest()


def input_fingerprint(spark: SparkSession, path: str) -> str:
    """Path, size and modification time of every file of the input, and the version of the code."""
    p, fs = _fs(spark, path)
    files, found = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath().toString()}|{f.getLen()}|{f.getModificationTime()}")
    key = "\n".join([fs.makeQualified(p).toString(), _code_version(), *sorted(found)])
    return hashlib.sha1(key.encode()).hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _publish(spark: SparkSession, tmp: str, final: str) -> None:
    """Move a finished folder into place; if another job published first, keep theirs. Where a
    rename into an existing folder nests instead of failing, the nested copy is taken out again."""
    src, fs = _fs(spark, tmp)
    dst, _ = _fs(spark, final)
    fs.mkdirs(dst.getParent())
    if not fs.exists(dst) and fs.rename(src, dst):
        nested, _ = _fs(spark, f"{final}/{src.getName()}")
        if fs.exists(nested):
            fs.delete(nested, True)
        return
    if not fs.exists(dst):
        raise OSError(f"could not publish {tmp} as {final}")
    fs.delete(src, True)


def materialise(spark: SparkSession, sf_dir: str) -> str:
    """Build the Silver tables for ``sf_dir`` if they are not there yet; return their folder."""
    events_path = f"{sf_dir.rstrip('/')}/events.parquet"
    root = shared_scratch(spark, f"silver/{input_fingerprint(spark, events_path)}")
    if all(_exists(spark, f"{root}/{t}/_SUCCESS") for t in SILVER):
        return root
    raw = fbsrc.read_table(spark, sf_dir, "events")
    ev = fbsrc.fb_events(dealt(raw, raw.count(), ["event_id"]))  # footers have the count
    tmp = f"{root}/.tmp-{uuid.uuid4().hex}"
    # the sort leads with the partition columns: the writer would otherwise sort by them anew
    (ev.sortWithinPartitions("competition", "season", "match_id", "event_id")
     .write.partitionBy("competition", "season").parquet(f"{tmp}/events"))
    written = spark.read.parquet(f"{tmp}/events")
    # the derived tables are built from the written events, not from the raw JSON again
    fbsrc.fb_matches(written).write.parquet(f"{tmp}/matches")
    fbsrc.competitions_from_matches(spark.read.parquet(f"{tmp}/matches")).write.parquet(f"{tmp}/competitions")
    fbsrc.fb_lineups(written).write.parquet(f"{tmp}/lineups")
    for t in SILVER:
        _publish(spark, f"{tmp}/{t}", f"{root}/{t}")
    return root


_SCHEMAS: dict[str, object] = {}


def read_silver(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Read one Silver table; its schema is inferred from the footers once per process and
    passed explicitly afterwards (the files under a fingerprinted folder never change)."""
    path = f"{root}/{table}"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


class SilverTables:
    """Lazy accessor: only the tables a query touches are opened."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.root = spark, materialise(spark, sf_dir)

    def __getitem__(self, table: str) -> DataFrame:
        return read_silver(self.spark, self.root, table)


class StagedTables:
    """The staging models, built once from the landed files and read by the checks and marts."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.root = spark, staged(spark, sf_dir)

    def __getitem__(self, table: str) -> DataFrame:
        return read_silver(self.spark, self.root, table)


def staged(spark: SparkSession, sf_dir: str) -> str:
    """Write the four staging models of an input's landed files, and the match rows that did not
    pass under ``quarantine``, if they are not there yet; return their folder."""
    bronze = landed_bronze(spark, sf_dir)
    path = f"{materialise(spark, sf_dir)}/staging"
    if _exists(spark, f"{path}/_STAGED"):
        return path
    tmp = f"{path}.tmp-{uuid.uuid4().hex}"
    seen: list[tuple] = []

    def write(name: str, df: DataFrame, *parts: str) -> None:
        model = f"stg_{name}"
        seen.extend(dq.write_observed(model, df, SPECS[model], lambda w: w.partitionBy(*parts).parquet(f"{tmp}/{name}")))

    def matches() -> None:
        good, bad = sv.split_matches(br.read_matches(spark, bronze))
        write("matches", good)
        bad.write.parquet(f"{tmp}/quarantine")
        write("competitions", sv.stg_competitions(spark.read.parquet(f"{tmp}/matches")))

    order = ["competition", "season", "match_id", "period", "minute", "second", "event_index"]
    landed = br.epochs.manifest(spark, bronze).agg(F.sum("events")).first()[0] or 0
    events = dealt(sv.stg_events(br.read_bronze_events(spark, bronze), sort_within_match=False), landed,
                   [*order, "event_id"]).sortWithinPartitions(*order)
    models = [lambda: write("events", events, "competition", "season"), matches,
              lambda: write("lineups", sv.stg_lineups(br.flatten_lineups(br.read_lineups(spark, bronze))))]
    with ThreadPoolExecutor(len(models)) as pool:  # independent models are built side by side
        for done in [pool.submit(m) for m in models]:
            done.result()
    dq.observed_table(spark, seen).coalesce(1).write.parquet(f"{tmp}/observed")
    done, fs = _fs(spark, f"{tmp}/_STAGED")
    fs.create(done).close()
    _publish(spark, tmp, path)
    return path


def silver_tables(spark: SparkSession, sf_dir: str) -> SilverTables:
    return SilverTables(spark, sf_dir)


def gold_table(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A mart materialised once per input under the Silver folder (``<root>/gold/<name>``) and
    read by every later consumer -- checks, serving lists, exports, outcome features -- the way
    the SQL original's tests and reports read its mart tables. ``build()`` returns the mart plan.
    """
    root = materialise(spark, sf_dir)
    path = f"{root}/gold/{name}"
    if not _exists(spark, f"{path}/_SUCCESS"):
        tmp = f"{root}/gold/.tmp-{name}-{uuid.uuid4().hex}"
        mart = MARTS[name]
        seen = dq.write_observed(mart, build(), SPECS[mart], lambda w: w.parquet(f"{tmp}/rows"))
        dq.observed_table(spark, seen).coalesce(1).write.parquet(f"{tmp}/observed")
        _publish(spark, f"{tmp}/observed", f"{root}/observed/{name}")
        _publish(spark, f"{tmp}/rows", path)
    return read_silver(spark, root, f"gold/{name}")


#: Rows of a bucket of the per-second table, and its least number of buckets.
BUCKET_ROWS, LEAST_BUCKETS = 1 << 18, 8


def table_name(spark: SparkSession, sf_dir: str, name: str) -> str:
    """An input's table in the session's catalogue."""
    return f"pitchline_{name}_{materialise(spark, sf_dir).rstrip('/').rsplit('/', 1)[1]}"


def bucketed_by_match(spark: SparkSession, sf_dir: str, name: str, build, sort: str) -> DataFrame:
    """B3 + I3: a table of the session's catalogue, bucketed by match and sorted inside the buckets, written
    once per input; windows and joins by match over it need no exchange. It is for tables that the match
    clock bounds: a hot match must not fill its bucket, so raw events are never bucketed so."""
    root, table = materialise(spark, sf_dir), table_name(spark, sf_dir, name)
    if spark.catalog.tableExists(table):
        return spark.table(table)
    p, fs = _fs(spark, f"{root}/buckets")
    found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    ready = next((f for f in found if f.startswith(f"{name}-") and _exists(spark, f"{root}/buckets/{f}/_SUCCESS")), None)
    if ready is None:
        rows = build()
        copy = f"{root}/buckets/.rows-{name}-{uuid.uuid4().hex}"
        rows.write.parquet(copy)  # counted and bucketed from here, so the build runs once
        rows = spark.read.schema(rows.schema).parquet(copy)
        n = max(LEAST_BUCKETS, -(-rows.count() // BUCKET_ROWS))
        path = f"{root}/buckets/{name}-{n}"
        (rows.repartition(n, "match_id").write.bucketBy(n, "match_id").sortBy("match_id", sort)
         .option("path", path).saveAsTable(table))
        return spark.table(table)
    path, n = f"{root}/buckets/{ready}", int(ready.rsplit("-", 1)[1])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (match_id) SORTED BY (match_id, {sort}) INTO {n} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, check_name, column_name, failures) as observed while the staging models and the
    marts that were built so far were written; ``check_name`` 'rows' has their numbers of rows."""
    root = materialise(spark, sf_dir)
    paths = [f"{staged(spark, sf_dir)}/observed", *[p for m in MARTS if _exists(spark, p := f"{root}/observed/{m}")]]
    return spark.read.schema("table_name string, check_name string, column_name string, failures long").parquet(*paths)


def landed_bronze(spark: SparkSession, sf_dir: str) -> str:
    """The raw-shaped bronze landing of this input, written once and published by renaming the
    finished folder; returns its path."""
    root = materialise(spark, sf_dir)
    path = f"{root}/bronze"
    if not _exists(spark, f"{path}/_LANDED"):
        tmp = f"{root}/.tmp-bronze-{uuid.uuid4().hex}"
        br.land(SilverTables(spark, sf_dir), tmp)
        done, fs = _fs(spark, f"{tmp}/_LANDED")
        fs.create(done).close()
        _publish(spark, tmp, path)
    return path
