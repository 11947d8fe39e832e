"""Bronze layer: land raw-shaped, sparse Parquet and read it back.

Layout (append-only epochs, Hive partitions, no per-match folders -> no small-file explosion):

    <root>/events/epoch=<n>/type=<event kind>/competition=<c>/season=<s>/part-*.parquet
    <root>/matches/epoch=<n>/competition_folder_name=<c>/part-*.parquet
    <root>/lineups/epoch=<n>/competition=<c>/season=<s>/part-*.parquet   (nested: team -> players)
    <root>/competitions/part-*.parquet
    <root>/manifest/epoch=<n>/part-*.parquet                             (complete matches; see ``epochs``)

Event files are *sparse*: each event kind is written with only the columns that kind carries
(shot columns only in shot files, ...), with raw names (``id``, ``type``, ``location`` arrays,
float ids with NaN for missing). Readers group the files by their footers (see ``footers``), cast
each group to the declared types and unite them by name (missing -> NULL).
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.session import ROWS_PER_TASK, dealt, temporary_folder
from pitchline.sources import epochs
from pitchline.sources.footers import FILES_PER_TASK, data_files, footers, read_groups
from pitchline.sources.wide import LINEUP_RULES, LOCATION_Y, MATCH_RULES, RULES, rule

col = F.col

# The event kinds and the kind-specific raw columns each kind's files carry.
KIND_COLUMNS = {
    "Pass": ["pass_end_location", "pass_outcome", "pass_assisted_shot_id", "pass_shot_assist"],
    "Carry": ["carry_end_location"],
    "Shot": ["shot_expected_goals", "shot_type", "shot_outcome"],
    "Pressure": ["counterpress"],
    "Duel": ["duel_type"],
    "Dribble": ["dribble_outcome"],
    "Ball Recovery": [],
    "Foul Committed": [],
}
for _name, (_kind, _, _) in RULES.items():
    if _kind is not None:
        KIND_COLUMNS[_kind].append(_name)
COMMON_COLUMNS = [*[n for n, (k, _, _) in RULES.items() if k is None], "id", "ts", "match_id", "period", "minute", "second", "possession", "team",
                  "player_id", "player", "position", "play_pattern", "location"]

_TYPES = {"int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
          "array<string>": T.ArrayType(T.StringType()), "array<double>": T.ArrayType(T.DoubleType())}

# Declared bronze schema: the type every reader casts to, whatever a file group holds.
BRONZE_EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("match_id", T.LongType()), T.StructField("period", T.IntegerType()),
    T.StructField("minute", T.LongType()), T.StructField("second", T.LongType()),
    T.StructField("possession", T.LongType()), T.StructField("team", T.StringType()),
    T.StructField("player_id", T.DoubleType()), T.StructField("player", T.StringType()),
    T.StructField("position", T.StringType()), T.StructField("play_pattern", T.StringType()),
    T.StructField("location", T.ArrayType(T.DoubleType())),
    T.StructField("pass_end_location", T.ArrayType(T.DoubleType())),
    T.StructField("pass_outcome", T.StringType()),
    T.StructField("pass_assisted_shot_id", T.DoubleType()),
    T.StructField("pass_shot_assist", T.BooleanType()),
    T.StructField("carry_end_location", T.ArrayType(T.DoubleType())),
    T.StructField("shot_expected_goals", T.DoubleType()), T.StructField("shot_type", T.StringType()),
    T.StructField("shot_outcome", T.StringType()), T.StructField("counterpress", T.BooleanType()),
    T.StructField("duel_type", T.StringType()), T.StructField("dribble_outcome", T.StringType()),
    *[T.StructField(n, _TYPES[t]) for n, (_, t, _) in RULES.items()],
])


def _float_id(c: Column) -> Column:
    """Raw ids arrive as floats with NaN for missing (pandas-style)."""
    return F.coalesce(c.cast("double"), F.lit(float("nan")))


def raw_events(fb: DataFrame) -> DataFrame:
    """FB view -> raw bronze column names and shapes (all kinds, all columns)."""
    loc = lambda c: F.when(col(c).isNotNull(), F.array(col(c), F.expr(LOCATION_Y)))
    return fb.select(
        col("event_id").alias("id"), "ts", "match_id", "competition", "season", "period", "minute",
        "second", col("event_type").alias("type"), col("possession_sequence").alias("possession"),
        "team", _float_id(col("player_id")).alias("player_id"), col("player_name").alias("player"),
        col("player_position").alias("position"), "play_pattern", loc("start_x").alias("location"),
        F.when(col("event_type") == "Pass", loc("end_x")).alias("pass_end_location"),
        "pass_outcome",
        F.when(col("event_type") == "Pass", _float_id(col("pass_assisted_shot_id")))
        .alias("pass_assisted_shot_id"),
        F.when(col("pass_shot_assist"), F.lit(True)).alias("pass_shot_assist"),
        F.when(col("event_type") == "Carry", loc("end_x")).alias("carry_end_location"),
        col("xg").alias("shot_expected_goals"), "shot_type", "shot_outcome",
        # sparse boolean: present only where true, as the raw feed omits false flags
        F.when(col("counterpress"), F.lit(True)).alias("counterpress"),
        "duel_type", "dribble_outcome",
        *[F.expr(rule(n, "array")).cast(t).alias(n) for n, (_, t, _) in RULES.items()])


def land_raw_events(raw: DataFrame, root: str, epoch: int = 0, rows_per_task: int = ROWS_PER_TASK) -> None:
    """B1: write one sparse file group per known event kind, partitioned by competition and
    season, and every other kind (also a missing one) with all columns, into an epoch of their own.

    The input is dealt out by ranges of (kind, competition, season, match, event):
    as many as its size asks for, so a large competition or match is written by many tasks and each
    file holds neighbouring matches in order. Each kind then writes its own part, dealt out anew if one
    task can't hold it: the spread files of many tasks are read by few, as they are small."""
    spark = raw.sparkSession
    epochs.clear_epoch(spark, f"{root}/events/epoch={epoch}")
    parts, order = ["competition", "season"], ["competition", "season", "match_id", "id"]
    own = F.when(col("type").isin(list(KIND_COLUMNS)), col("type"))  # NULL: any other kind
    counts = {r.kind: r.rows for r in raw.groupBy(own.alias("kind")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    tasks = max(1, -(-sum(counts.values()) // rows_per_task))  # the ranges' sample reads the five keys
    spread = temporary_folder(spark, "landing")
    raw.repartitionByRange(tasks, "type", *order).write.partitionBy("type").parquet(spread)
    raw = spark.read.schema(raw.schema).parquet(spread)
    target = f"{root}/events/epoch={epoch}"

    def write(kind: str) -> None:
        rows = raw.where(col("type") == kind).select(*COMMON_COLUMNS, *KIND_COLUMNS[kind], *parts)
        rows = dealt(rows, counts.get(kind, 0), order, rows_per_task)
        rows.sortWithinPartitions(*order).write.partitionBy(*parts).parquet(f"{target}/type={kind}")

    def write_others() -> None:
        other = raw.where(F.coalesce(~col("type").isin(list(KIND_COLUMNS)), F.lit(True)))
        other = dealt(other, counts.get(None, 0), ["type", *order], rows_per_task)
        other.sortWithinPartitions("type", *order).write.mode("append").partitionBy("type", *parts).parquet(target)

    with ThreadPoolExecutor(len(KIND_COLUMNS)) as pool:  # independent jobs: small kinds don't wait for large ones
        list(pool.map(write, KIND_COLUMNS))
    write_others()


def land_events(fb: DataFrame, root: str, epoch: int = 0) -> None:
    """B1 for the football view."""
    land_raw_events(raw_events(fb), root, epoch)


def event_groups(spark: SparkSession, root: str) -> dict[str, set[str]]:
    """For each landed event kind the columns that its files' footers hold."""
    known = footers(spark, f"{root}/events")
    out: dict[str, set[str]] = {}
    for fingerprint, files in known.groups.items():
        for file in files:
            kind = file.split("/type=", 1)[1].split("/", 1)[0]
            out.setdefault(kind, set()).update(known.schemas[fingerprint].names)
    return out


def match_groups(spark: SparkSession, root: str) -> list[str]:
    """The competitions whose match metadata was landed."""
    mark = "/competition_folder_name="
    return sorted({f.split(mark, 1)[1].split("/", 1)[0] for f, _, _ in data_files(spark, f"{root}/matches") if mark in f})


def read_sparse_union(spark: SparkSession, paths: list[str], schema: T.StructType,
                      base_path: str | None = None, partitions: dict[str, str] | None = None) -> DataFrame:
    """A1: one DataFrame from folders whose files have different column sets and drifting types.

    Files are grouped by their footers' schemas, whatever folder they lie in, so that no file's
    columns are taken for another's; every declared column present is cast to its declared type and
    absent ones become typed NULLs, then the groups are united by name. ``mergeSchema`` cannot do
    this: it fails on long-vs-double. ``partitions`` names the columns, and their types, that come
    from folders below ``base_path``. A folder without any data file has no rows; a missing folder
    and an unreadable file raise. ``schema`` lists the columns that are there even if no file has them.
    """
    parts = [read_groups(spark, p, schema, base_path, partitions=partitions) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


EVENT_PARTITIONS = {"epoch": "int", "type": "string", "competition": "string", "season": "int"}


def _counted(rows: DataFrame, root: str, committed: bool) -> DataFrame:
    return epochs.visible(rows, root) if committed else rows.drop("epoch")


def read_bronze_events(spark: SparkSession, root: str, committed: bool = True) -> DataFrame:
    """A1 + A2: the events of all complete matches (without ``committed``: every landed row) with
    ``type``, ``competition`` and ``season`` from the path."""
    rows = read_sparse_union(spark, [f"{root}/events"], BRONZE_EVENT_SCHEMA, f"{root}/events", EVENT_PARTITIONS)
    return _counted(rows, root, committed)


def read_bronze_merged(spark: SparkSession, root: str, committed: bool = True) -> DataFrame:
    """A1 + A2 with the declared schema: no footer is read to find columns, missing ones are NULL.
    Valid while the files' types are the declared ones."""
    parts = T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in EVENT_PARTITIONS.items()))
    rows = spark.read.schema(T.StructType([*BRONZE_EVENT_SCHEMA.fields, *parts.fields])).parquet(f"{root}/events")
    return _counted(rows, root, committed)


def read_matches(spark: SparkSession, root: str, committed: bool = True, competition: str | None = None) -> DataFrame:
    """Landed match metadata, of one competition if it is named."""
    rows = spark.read.parquet(f"{root}/matches")
    if competition is not None:
        rows = rows.where(col("competition_folder_name") == competition)
    return _counted(rows, root, committed)


def read_lineups(spark: SparkSession, root: str, committed: bool = True) -> DataFrame:
    """Landed nested lineups."""
    return _counted(spark.read.parquet(f"{root}/lineups"), root, committed)


def raw_matches(matches: DataFrame) -> DataFrame:
    """Match metadata in raw shape: dates as text, scores as floats, 'nan' for missing texts."""
    return matches.select(
        "match_id", "competition_folder_name", "season_year",
        F.date_format("match_date", "yyyy-MM-dd").alias("match_date"),
        "home_team_name", "away_team_name",
        col("home_score").cast("double").alias("home_score"),
        col("away_score").cast("double").alias("away_score"),
        "competition_stage_name",
        *[F.expr(sql).cast(t).alias(n) for n, (t, sql) in MATCH_RULES.items()])


def _land(rows: DataFrame, folder: str, parts: list[str]) -> None:
    epochs.clear_epoch(rows.sparkSession, folder)
    rows.write.partitionBy(*parts).parquet(folder)


def land_matches(matches: DataFrame, root: str, epoch: int = 0) -> None:
    """B2: match metadata, written anew on every run, into the run's epoch."""
    _land(raw_matches(matches), f"{root}/matches/epoch={epoch}", ["competition_folder_name"])


def land_competitions(comps: DataFrame, root: str) -> str:
    """B2: competitions, written once: ``mode('ignore')`` leaves an existing folder untouched."""
    path = f"{root}/competitions"
    comps.write.mode("ignore").parquet(path)
    return path


def nest_lineups(lineups: DataFrame) -> DataFrame:
    """Raw lineup shape: one row per match with ``map<team, array<player>>``.
    Two bounded collections: players of one team in one match, then the two teams of a match."""
    per_team = (lineups.groupBy("match_id", "competition_folder_name", "season_year", "team_name")
                .agg(F.collect_list(F.struct(
                    _float_id(col("player_id")).alias("player_id"), col("player_name"),
                    *[F.expr(sql.replace("ARR(", "array(")).cast(t).alias(n) for n, (t, sql) in LINEUP_RULES.items()],
                    col("positions"))).alias("players")))
    return (per_team.groupBy("match_id", col("competition_folder_name").alias("competition"),
                             col("season_year").alias("season"))
            .agg(F.map_from_entries(F.collect_list(F.struct("team_name", "players"))).alias("teams")))


def land_lineups(lineups: DataFrame, root: str, epoch: int = 0) -> None:
    _land(nest_lineups(lineups), f"{root}/lineups/epoch={epoch}", ["competition", "season"])


def commit(spark: SparkSession, root: str, epoch: int = 0, expected: DataFrame | None = None) -> DataFrame:
    """The epoch's complete matches, counted from what was written, become visible."""
    counts = {d: spark.read.schema("match_id long").option("recursiveFileLookup", "true").parquet(f"{root}/{d}/epoch={epoch}")
              .groupBy("match_id").agg(F.count(F.lit(1)).alias("rows")) for d in epochs.DATASETS}
    return epochs.commit(spark, root, epoch, counts, expected)


def land_run(tables, root: str, epoch: int | None = None) -> int:
    """One landing run of some matches: events, lineups and metadata into a new epoch, then the
    manifest. What other runs have landed stays as it is."""
    spark = tables["events"].sparkSession
    epoch = epochs.next_epoch(spark, root) if epoch is None else epoch
    land_events(tables["events"], root, epoch)
    land_matches(tables["matches"], root, epoch)
    land_lineups(tables["lineups"], root, epoch)
    commit(spark, root, epoch)
    return epoch


def land(tables, root: str) -> None:
    """B1 + B2: the full raw-shaped landing of one input's events, matches, lineups, competitions."""
    land_run(tables, root)
    land_competitions(tables["competitions"], root)


def drop_by_match(rows: DataFrame, folder: str, matches: int) -> None:
    """Raw files as a feed drops them: one below a folder ``match_id=<id>`` for each of ``matches``.
    A file costs more than its rows, so tasks are dealt files, not bytes."""
    rows.repartition(-(-matches // FILES_PER_TASK) or 1, "match_id").write.partitionBy("match_id").parquet(folder)


def land_incoming(spark: SparkSession, incoming: str, root: str) -> int:
    """Lands raw files dropped below ``incoming``, one folder ``match_id=<id>`` a match for
    ``events`` and ``lineups``, and ``matches``; a match with a file that can't be read goes to
    ``<root>/quarantine`` with path and reason and is left out of all three datasets, everything
    else is landed.

    Footers tell unreadable files before anything is read and how many rows each match ought to
    have; a page that turns out unreadable later ends its file, so that the match comes short of
    these rows, isn't committed and is quarantined too. Every event file is opened once: what it
    holds is written to a few large files, which the landing then counts, samples and sorts."""
    epoch = epochs.next_epoch(spark, root)
    raw, due, bad = {}, [], []
    for name, schema, types in (("events", BRONZE_EVENT_SCHEMA, {"match_id": "long"}), ("lineups", T.StructType(), {"match_id": "long"})):
        path = f"{incoming}/{name}"
        own = T.StructType([f for f in schema.fields if f.name != "match_id"])
        raw[name] = read_groups(spark, path, own, path, True, types, skip_corrupt=True)
        known = footers(spark, path)
        due += [(_match_of(f), name, n) for f, n in known.rows.items()]
        bad += [(_match_of(f), name, f, why) for f, why in known.unreadable.items()]
    refused = spark.createDataFrame(bad, "match_id long, dataset string, path string, reason string")
    skip = refused.select("match_id").distinct()
    events, gathered = raw["events"].join(skip, "match_id", "left_anti"), temporary_folder(spark, "incoming")
    events.write.parquet(gathered)
    land_raw_events(spark.read.schema(events.schema).parquet(gathered), root, epoch)
    _land(raw["lineups"].join(skip, "match_id", "left_anti"), f"{root}/lineups/epoch={epoch}", ["competition", "season"])
    matches = spark.read.parquet(f"{incoming}/matches").join(skip, "match_id", "left_anti")
    _land(matches, f"{root}/matches/epoch={epoch}", ["competition_folder_name"])
    expected = spark.createDataFrame(due, "match_id long, dataset string, rows long").join(skip, "match_id", "left_anti").groupBy(
        "match_id", "dataset").agg(F.sum("rows").alias("rows"))
    done = commit(spark, root, epoch, expected)
    short = expected.join(done.select("match_id"), "match_id", "left_anti").select(
        "match_id", "dataset", F.concat(F.lit(f"{incoming}/"), "dataset", F.lit("/match_id="), col("match_id").cast("string")).alias("path"),
        F.lit("rows lost while reading, or no rows in another dataset").alias("reason"))
    refused.unionByName(short).write.mode("overwrite").parquet(f"{root}/quarantine/epoch={epoch}")
    return epoch


def _match_of(file: str) -> int | None:
    found = re.search(r"/match_id=(\d+)/", file)
    return int(found[1]) if found else None


def flatten_lineups(nested: DataFrame) -> DataFrame:
    """Team -> players map to one flat frame with ``team_name`` (one row per player-match)."""
    return (nested.select("match_id", "competition", "season",
                          F.explode("teams").alias("team_name", "players"))
            .select("match_id", "competition", "season", "team_name",
                    F.explode("players").alias("p"))
            .select("match_id", "competition", "season", "team_name", "p.*"))


def flatten_location(df: DataFrame, components: dict[str, int] | None = None,
                     suffix: str = "_location", three_d: tuple = ("shot_end_location",)) -> DataFrame:
    """Every array column ``<name>`` -> ``<name>_x``, ``<name>_y`` (and ``_z`` for 3-D ones),
    1-based, NULL when the array is shorter or NULL; the source column is dropped.

    By default the columns are those whose name ends in ``suffix`` (a bare ``location`` does not
    match); ``components`` maps explicit columns to their number of components instead.
    """
    if components is None:
        components = {f.name: (3 if f.name in three_d else 2) for f in df.schema.fields
                      if f.name.endswith(suffix) and isinstance(f.dataType, T.ArrayType)}
    out = df
    for name, n in components.items():
        for i, axis in enumerate("xyz"[:n]):
            out = out.withColumn(f"{name}_{axis}", F.get(col(name), i))
        out = out.drop(name)
    return out


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Concatenate frames by column name; a column missing from a frame becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def complete_matches(spark: SparkSession, root: str) -> DataFrame:
    """Match ids landed in ALL three datasets: the manifest's. A run that crashed before its commit
    leaves its matches out, so they are retried instead of skipped forever; no event is read."""
    return epochs.newest(spark, root).select("match_id")


def pending_matches(incoming: DataFrame, complete: DataFrame) -> DataFrame:
    """Incoming matches not yet fully landed (one anti-join, no driver-side loop)."""
    return incoming.join(complete, "match_id", "left_anti")
