"""A catalogue of Parquet footers, and the sparse read that follows from it.

Files of one dataset need not agree: one lacks a column that its neighbour has, one holds a number
as integer and another as double. Reading a folder with the schema of whichever footer is picked
loses columns silently, and merging schemas fails on drifting types. So every file's footer is read
in tasks; files of the same schema form a group, each group is read with its own schema, every
column is cast to its declared (or, where none is declared, the widest) type, and the groups are
united by name. Files whose footer can't be read are told apart with the reason.
"""

from __future__ import annotations

import hashlib
import io
import json
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from threading import Lock

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

col = F.col

#: Schemes whose files tasks open themselves, so that only the footer is read; files of any other
#: store come through Spark's reader, whole.
OPENED = ("file", "hdfs", "s3", "gs")
#: Footers that one task reads.
FILES_PER_TASK = 64
CATALOGUE = "path string, fingerprint string, schema string, rows long, reason string"
_KEPT_ROOTS = 16


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every data file below a folder, as Spark's own listing
    has them on the driver. A missing folder raises. Hadoop's listing costs some round trips to the
    JVM a file, so local files are listed here."""
    p, fs = _qualified(spark, path)
    if p.toString().startswith("file:"):
        return sorted(_local_files("/" + p.toString()[5:].lstrip("/")))
    files, found = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def _qualified(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p), fs


def _local_files(path: str) -> Iterator[tuple[str, int, int]]:
    import pyarrow.fs as fs

    store = fs.LocalFileSystem()
    info = store.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    for f in [info] if info.is_file else store.get_file_info(fs.FileSelector(path, recursive=True)):
        if f.is_file and not f.base_name.startswith(("_", ".")):
            yield f"file:{f.path}", f.size, f.mtime_ns // 1_000_000


def _opened(path: str):
    import pyarrow.fs as fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _plain(schema: str) -> tuple[str, str]:
    """A schema's fingerprint and the schema, without what files of the same columns may differ in."""
    fields = [{k: f[k] for k in ("name", "type", "nullable")} for f in json.loads(schema)["fields"]]
    schema = json.dumps({"type": "struct", "fields": [f | {"nullable": True, "metadata": {}} for f in fields]})
    return hashlib.md5(schema.encode()).hexdigest(), schema


def _footer(path: str, content: bytes | None, plain: dict[str, tuple[str, str]]) -> tuple[str, str | None, str | None, int | None, str | None]:
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    try:
        file = pq.ParquetFile(_opened(path) if content is None else io.BytesIO(content))
        notes = file.metadata.metadata or {}
        own = notes.get(b"org.apache.spark.sql.parquet.row.metadata")
        schema = own.decode() if own else from_arrow_schema(file.schema_arrow).json()
    except (OSError, pa.ArrowException) as e:  # a missing, cut or foreign file
        return path, None, None, None, f"unreadable footer: {str(e).splitlines()[0][:120]}"
    if schema not in plain:
        plain[schema] = _plain(schema)
    return path, *plain[schema], file.metadata.num_rows, None


def footer_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(path, fingerprint, schema, rows, reason) of every data file below ``path``: the schema as
    JSON and its fingerprint, or the reason why the footer can't be read. A task gives each schema
    with one of its files; the others have NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, given = {}, set()
        for batch in batches:
            contents, rows = batch.column("content").to_pylist(), []
            for p, c in zip(batch.column("path").to_pylist(), contents, strict=True):
                path, fingerprint, schema, n, reason = _footer(p, c, plain)
                rows.append((path, fingerprint, None if fingerprint in given else schema, n, reason))
                given.add(fingerprint)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(),) * 3 + (pa.int64(), pa.string()))],
                ["path", "fingerprint", "schema", "rows", "reason"])

    files = [f for f, _, _ in data_files(spark, path)]
    near = [f for f in files if f.split(":", 1)[0] in OPENED or ":" not in f]
    far = sorted(set(files) - set(near))
    parts = [spark.createDataFrame([], "path string, content binary")]
    if near:
        parts.append(spark.createDataFrame([(f,) for f in near], "path string").repartition(
            -(-len(near) // FILES_PER_TASK)).withColumn("content", F.lit(None).cast("binary")))
    if far:
        parts.append(spark.read.format("binaryFile").load(far).select("path", "content"))
    return reduce(DataFrame.unionByName, parts).mapInArrow(run, CATALOGUE)


class Footers:
    """What the driver needs to know of a folder: each file's group, the groups' schemas, and the
    unreadable files. One row of names a file, one schema a group."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        rows = footer_catalogue(spark, path).withColumn("n", F.row_number().over(_any_of("fingerprint"))).withColumn(
            "schema", F.when(col("n") == 1, col("schema"))).drop("n").collect()
        self.root = _qualified(spark, path)[0].toString()
        self.schemas = {r.fingerprint: T.StructType.fromJson(json.loads(r.schema)) for r in rows if r.schema}
        self.groups: dict[str, list[str]] = {}
        self.rows: dict[str, int] = {}
        self.unreadable: dict[str, str] = {}
        for r in sorted(rows, key=lambda r: r.path):
            if r.reason is None:
                self.groups.setdefault(r.fingerprint, []).append(r.path)
                self.rows[r.path] = r.rows
            else:
                self.unreadable[r.path] = r.reason


def _any_of(key: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(col("schema").isNull(), "path")


_KNOWN: dict[tuple, Footers] = {}
_LISTING = Lock()


def footers(spark: SparkSession, path: str) -> Footers:
    """The folder's footers, read once a process for the same files of the same length and time."""
    key = (path, hashlib.sha1(repr(data_files(spark, path)).encode()).hexdigest())
    if key not in _KNOWN:
        if len(_KNOWN) >= _KEPT_ROOTS:
            _KNOWN.pop(next(iter(_KNOWN)))
        _KNOWN[key] = Footers(spark, path)
    return _KNOWN[key]


def widest(kinds: list[T.DataType]) -> T.DataType:
    """A type that holds the values of all: the one there is, the widest of whole numbers, double
    for numbers, text otherwise."""
    kinds = list(dict.fromkeys(kinds))
    if len(kinds) == 1:
        return kinds[0]
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if all(k in whole for k in kinds):
        return max(kinds, key=whole.index)
    if all(k in [*whole, T.FloatType(), T.DoubleType()] for k in kinds):
        return T.DoubleType()
    if all(isinstance(k, T.ArrayType) for k in kinds):
        return T.ArrayType(widest([k.elementType for k in kinds]))
    return T.StringType()


def read_groups(spark: SparkSession, root: str, schema: T.StructType, base_path: str | None = None, skip_unreadable: bool = False,
                partitions: dict[str, str] | None = None, paths: list[str] | None = None, skip_corrupt: bool = False) -> DataFrame:
    """All files below ``root`` (those below ``paths``, if given) united by column name.

    Columns of ``schema`` are there in its types, NULL where a file lacks them; further columns in
    the widest of their types. ``partitions`` gives the types of columns that come from folder names
    below ``base_path``. An unreadable file raises unless ``skip_unreadable``; a page that can't be
    read raises unless ``skip_corrupt``, which ends its file there.
    """
    known = footers(spark, root)
    if known.unreadable and not skip_unreadable:
        path, reason = next(iter(known.unreadable.items()))
        raise OSError(f"{path}: {reason}")
    declared = {f.name: f.dataType for f in schema.fields}
    of: dict[str, list[T.DataType]] = {}
    for fingerprint in known.groups:
        for f in known.schemas[fingerprint].fields:
            of.setdefault(f.name, []).append(f.dataType)
    kinds = declared | {name: widest(some) for name, some in of.items() if name not in declared}
    partitions = partitions or {}
    types = ", ".join(f"`{n}` {t}" for n, t in partitions.items())
    parts = [spark.createDataFrame([], T.StructType([*[T.StructField(n, t) for n, t in kinds.items()], *(T._parse_datatype_string(types).fields if types else [])]))]
    wanted = {g: [f for f in files if paths is None or any(_below(f, p) for p in paths)] for g, files in known.groups.items()}
    all_files = [*known.rows, *([] if skip_corrupt else known.unreadable)]  # with it, an unreadable file has no rows
    for fingerprint, files in wanted.items():
        if not files:
            continue
        if base_path:  # without it, names of folders would become columns
            files = _folders(files, all_files, known.root)
        own = known.schemas[fingerprint]
        reader = spark.read.schema(own).option("ignoreCorruptFiles", str(skip_corrupt).lower())
        with _listing_tasks(spark, len(known.rows)):
            rows = (reader.option("basePath", base_path) if base_path else reader).parquet(*files)
        parts.append(rows.select(*[_as(own, n, t) for n, t in kinds.items()], *[col(n).cast(t).alias(n) for n, t in partitions.items()]))
    return reduce(lambda a, b: a.unionByName(b), parts)


@contextmanager
def _listing_tasks(spark: SparkSession, files: int) -> Iterator[None]:
    """Spark lists folders in up to 10,000 tasks, one each; here in as many as read their footers."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    with _LISTING:
        before = spark.conf.get(key)
        spark.conf.set(key, str(min(int(before), -(-files // FILES_PER_TASK) or 1)))
        try:
            yield
        finally:
            spark.conf.set(key, before)


def _folders(files: list[str], all_files: list[str], root: str) -> list[str]:
    """``files``, or the fewest folders below ``root`` that together hold them and no other of
    ``all_files``: Spark checks and lists what it is given path by path."""
    start = len(root.rstrip("/")) + 1
    if any(part.startswith(("_", ".")) for f in files for part in f[start:].split("/")):
        return files  # Spark's listing passes such folders over

    def above(file: str) -> list[str]:
        parts = file[start:].split("/")
        return [file[: start - 1], *(file[:start] + "/".join(parts[:i]) for i in range(1, len(parts)))]

    own = set(files)
    mixed = {folder for f in all_files if f not in own for folder in above(f)}
    return list(dict.fromkeys(next((x for x in above(f) if x not in mixed), f) for f in files))


def _below(file: str, folder: str) -> bool:
    plain = [s.split(":", 1)[1] if ":" in s.split("/", 1)[0] else s for s in (file, folder)]
    return ("/" + plain[0].lstrip("/")).startswith("/" + plain[1].strip("/") + "/")


def _as(own: T.StructType, name: str, kind: T.DataType) -> Column:
    if name not in own.names:
        return F.lit(None).cast(kind).alias(name)
    return (col(f"`{name}`") if own[name].dataType == kind else col(f"`{name}`").cast(kind)).alias(name)


import sys  # noqa: E402

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package
