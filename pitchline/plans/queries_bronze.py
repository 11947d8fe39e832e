"""Registered queries for the bronze landing and silver staging layers.

The FB tables are landed as raw-shaped Parquet once per input (the ingestion run) under the shared
checkpoint location, and the bronze / silver queries read and clean those files. Scenarios that
need their own landing history (incremental re-runs, sink round trips) land into fresh folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.functions.exprs import round_half_away as rnd
from pitchline.operators import quality as dq
from pitchline.plans import team_marts as tm
from pitchline.plans.catalog import Tables, query
from pitchline.session import temporary_folder
from pitchline.sources import bronze as br
from pitchline.sources import fb as fbsrc
from pitchline.sources import silver as sv
from pitchline.sources.warehouse import landed_bronze, silver_tables

col = F.col

def _root(spark) -> str:
    return temporary_folder(spark, "bronze")


def land_all(spark, sf) -> tuple[str, Tables]:
    """The input's bronze landing, written once per input (like one ingestion run) and read by
    every bronze / silver query."""
    return landed_bronze(spark, sf), Tables(spark, sf)


def _silver_matches(spark, root: str) -> DataFrame:
    return sv.stg_matches(br.read_matches(spark, root))


def _fields_as_text(names: list[str]):
    return lambda x: F.concat_ws(",", *[F.coalesce(x[n].cast("string"), F.lit("null")) for n in names])


def as_text(df: DataFrame) -> DataFrame:
    """Every column, with those whose values engines print or compare differently as plain text:
    arrays joined by '|', doubles that may be NaN in lower case, timestamps to the microsecond."""
    out = []
    for f in df.schema.fields:
        c = col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            c = F.array_join(F.transform(c, _fields_as_text(f.dataType.elementType.names)), "|")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), "|", "null")
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif f.name.endswith("_id") and isinstance(f.dataType, T.DoubleType):
            c = F.lower(c.cast("string"))
        out.append(c.alias(f.name))
    return df.select(*out)


def _drifting(raw: DataFrame) -> dict[str, DataFrame]:
    """Raw events cut into shapes, each without columns that are NULL in all of its rows and some
    with other number types, as files written a match at a time differ."""
    flags = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.BooleanType)]
    places = ["location", "pass_end_location", "carry_end_location"]
    known, named, flagged = ~F.isnan("player_id"), col("player").isNotNull(), F.coalesce(*[col(f"`{c}`") for c in flags]).isNotNull()
    placed = F.coalesce(*places).isNotNull()
    whole_id, real_minute = col("player_id").cast("long"), col("minute").cast("double")
    return {
        "nobody": raw.where(~known & ~named & ~flagged).drop("player", *flags).withColumn("player_id", col("player_id").cast("float")),
        "unplaced": raw.where(known & ~flagged & ~placed).drop(*flags, *places).withColumn("period", col("period").cast("long")),
        "unflagged": raw.where(known & ~flagged & placed).drop(*flags).withColumn("player_id", whole_id),
        "flagged": raw.where(known & flagged).withColumn("player_id", whole_id).withColumn("minute", real_minute),
        "unknown": raw.where(~known & flagged).withColumn("minute", real_minute),
        "stray": raw.where(~known & named & ~flagged),
    }


@query("scan_sparse_union")
def q_scan_sparse_union(spark, sf):
    """A1: files of every kind in several shapes, with columns missing and numbers drifting between
    whole and double inside a kind's folder, read back without losing a value."""
    root, _ = land_all(spark, sf)
    folder = _root(spark)
    for shape, rows in _drifting(br.read_bronze_events(spark, root)).items():
        rows.withColumn("shape", F.lit(shape)).write.mode("append").partitionBy("type", "competition", "season").parquet(folder)
    parts = {"type": "string", "competition": "string", "season": "int"}
    return as_text(br.read_sparse_union(spark, [folder], br.BRONZE_EVENT_SCHEMA, folder, parts).drop("shape"))


@query("scan_hive_partitions")
def q_scan_hive_partitions(spark, sf):
    root, _ = land_all(spark, sf)
    b = br.read_bronze_merged(spark, root)
    return (b.groupBy("type", "competition", "season")
            .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("match_id").alias("n_matches")))


@query("bronze_profile")
def q_bronze_profile(spark, sf):
    """Per bronze column -- type, non-NULL count, NULL share, smallest text as a sample and
    the number of file groups whose footer holds the column (one aggregation pass)."""
    root, _ = land_all(spark, sf)
    b = br.read_bronze_events(spark, root)
    groups = list(br.event_groups(spark, root).values())
    fields = [f for f in b.schema.fields if f.name not in ("type", "competition", "season")]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, f in enumerate(fields):
        aggs += [F.count(col(f"`{f.name}`")).alias(f"c{i}"),
                 (F.min(col(f"`{f.name}`")) if isinstance(f.dataType, T.StringType) else F.lit(None).cast("string")).alias(f"s{i}")]
    row = b.agg(*aggs)
    entries = [F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                        col(f"c{i}").alias("non_null"), rnd(1 - col(f"c{i}") / col("_n"), 6).alias("null_share"),
                        col(f"s{i}").alias("sample_value"),
                        F.lit(sum(f.name in g for g in groups)).cast("long").alias("file_groups_with_column"))
               for i, f in enumerate(fields)]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


@query("table_inventory")
def q_table_inventory(spark, sf):
    """Register every source table as a view, list the catalog and count each table."""
    for name in fbsrc.TABLES:
        fbsrc.read_table(spark, sf, name).createOrReplaceTempView(f"src_{name}")
    own = {f"src_{name}" for name in fbsrc.TABLES}  # the session may hold views of others
    views = sorted(t.name for t in spark.catalog.listTables() if t.name in own)
    parts = [spark.table(v).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(v[len("src_"):]).alias("table_name"), "row_count") for v in views]
    return br.union_all(parts)


@query("flatten_location")
def q_flatten_location(spark, sf):
    """Every ``*_location`` array of the landed events, the shot's with its z; a bare
    ``location`` is not one of them."""
    root, _ = land_all(spark, sf)
    b = br.read_bronze_events(spark, root)
    ends = [c for c in b.columns if c.endswith("_location")]
    return br.flatten_location(b.select("id", *ends))


@query("flatten_lineups")
def q_flatten_lineups(spark, sf):
    root, _ = land_all(spark, sf)
    flat = br.flatten_lineups(br.read_lineups(spark, root))
    return as_text(flat)


@query("union_all_matches")
def q_union_all_matches(spark, sf):
    """C4: every landed competition's match files read one by one and concatenated."""
    root, _ = land_all(spark, sf)
    frames = [br.read_matches(spark, root, competition=c) for c in br.match_groups(spark, root)]
    return as_text(sv.stg_matches(br.union_all(frames)))


def _matches_of(t, ids: DataFrame) -> dict[str, DataFrame]:
    """The tables' rows of some matches."""
    return {n: t[n].join(ids.select("match_id"), "match_id", "left_semi").select(*t[n].columns) for n in ("events", "lineups", "matches")}


def _interrupted(spark, sf) -> tuple:
    """A landing history: a first run landed every 2022 match; a second one crashed on comp_1 2024
    after its events, before lineups, metadata and manifest."""
    t = silver_tables(spark, sf)
    root = _root(spark)
    br.land_run(_matches_of(t, t["matches"].where(col("season_year") == 2022)), root)
    br.land_events(t["events"].where(col("competition") == "comp_1"), root, 1)
    return t, root


@query("incremental_anti")
def q_incremental_anti(spark, sf):
    """After the interrupted run the pending list is every incoming match not
    landed in all three datasets."""
    t, root = _interrupted(spark, sf)
    pending = br.pending_matches(t["matches"], br.complete_matches(spark, root))
    return pending.select("match_id", "competition_folder_name", "season_year")


def _caught_up(spark, sf) -> str:
    """The pending list landed in two more runs, by odd and even matches, so that each adds to
    competitions and seasons that hold matches already; then 2022's are landed again."""
    t, root = _interrupted(spark, sf)
    for part in (0, 1):
        pending = br.pending_matches(t["matches"].where(F.expr("match_id div 3") % 2 == part), br.complete_matches(spark, root))
        br.land_run(_matches_of(t, pending), root)
    br.land_run(_matches_of(t, t["matches"].where(col("season_year") == 2022)), root)
    return root


@query("incremental_events")
def q_incremental_events(spark, sf):
    """Every landed event after five runs, of which one crashed and one landed matches
    a second time."""
    return as_text(br.read_bronze_events(spark, _caught_up(spark, sf)))


@query("incremental_lineups")
def q_incremental_lineups(spark, sf):
    """Every landed lineup row after the same five runs."""
    return as_text(br.flatten_lineups(br.read_lineups(spark, _caught_up(spark, sf))))


def _cut_file(spark, folder: str) -> None:
    """Leaves the first bytes of one data file of a folder, as a broken transfer does."""
    path, _, _ = br.data_files(spark, folder)[0]
    p, fs = br.epochs.path_of(spark, path)
    out = fs.create(p, True)
    out.write(b"PAR1 cut")
    out.close()


@query("quarantine_files")
def q_quarantine_files(spark, sf):
    """Raw files of every match dropped, the events of match 1 and the lineups of match 2
    cut short; what was landed of each match and what was quarantined for which dataset."""
    t = silver_tables(spark, sf)
    drop, root = _root(spark), _root(spark)
    n = t["matches"].count()
    br.drop_by_match(br.raw_events(t["events"]), f"{drop}/events", n)
    br.drop_by_match(br.nest_lineups(t["lineups"]), f"{drop}/lineups", n)
    br.raw_matches(t["matches"]).write.parquet(f"{drop}/matches")
    _cut_file(spark, f"{drop}/events/match_id=1")
    _cut_file(spark, f"{drop}/lineups/match_id=2")
    epoch = br.land_incoming(spark, drop, root)
    events = br.read_bronze_events(spark, root).groupBy("match_id").agg(F.count(F.lit(1)).alias("events"))
    players = br.flatten_lineups(br.read_lineups(spark, root)).groupBy("match_id").agg(F.count(F.lit(1)).alias("players"))
    landed = br.read_matches(spark, root).select("match_id").join(events, "match_id").join(players, "match_id").withColumn(
        "outcome", F.lit("landed"))
    refused = spark.read.parquet(f"{root}/quarantine/epoch={epoch}").select(
        "match_id", F.concat(F.lit("unreadable "), "dataset").alias("outcome"))
    return landed.unionByName(refused, allowMissingColumns=True)


@query("quarantine_split")
def q_quarantine_split(spark, sf):
    """Bronze events by the reason they are quarantined for, or accepted; one pass."""
    root, _ = land_all(spark, sf)
    b = br.read_bronze_events(spark, root)
    tagged = dq.tag_bad_records(b, {
        "missing_location": col("location").isNull(),
        "shootout_period": ~col("period").between(1, 4),
        "missing_player": F.isnan("player_id") | col("player_id").isNull()})
    outcome = F.coalesce("reject_reason", F.lit("accepted"))
    return tagged.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("rows"))


@query("stg_events")
def q_stg_events(spark, sf):
    root, _ = land_all(spark, sf)
    return as_text(sv.stg_events(br.read_bronze_events(spark, root)))


@query("stg_matches")
def q_stg_matches(spark, sf):
    root, _ = land_all(spark, sf)
    return as_text(_silver_matches(spark, root))


@query("stg_competitions")
def q_stg_competitions(spark, sf):
    root, _ = land_all(spark, sf)
    return sv.stg_competitions(_silver_matches(spark, root))


@query("stg_lineups")
def q_stg_lineups(spark, sf):
    root, _ = land_all(spark, sf)
    return as_text(sv.stg_lineups(br.flatten_lineups(br.read_lineups(spark, root))))


@query("sink_roundtrip")
def q_sink_roundtrip(spark, sf):
    """Overwrite a mart twice (idempotent), write competitions once with mode('ignore')
    (a second write is a no-op), then read the mart back from its files."""
    t = Tables(spark, sf)
    root = _root(spark)
    m1 = tm.mart_attack_quality(t.ev, t.comps)
    for _ in range(2):
        m1.write.mode("overwrite").parquet(f"{root}/mart_team_attack_quality")
        br.land_competitions(t.comps, root)
    return spark.read.parquet(f"{root}/mart_team_attack_quality")
