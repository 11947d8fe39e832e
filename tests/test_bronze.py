"""Bronze fixtures: type drift across sparse file groups, idempotent incremental landing."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF0001
from pitchline.session import shared_scratch
from pitchline.sources import bronze as br
from pitchline.sources import footers
from pitchline.sources import silver as sv
from pitchline.sources.warehouse import materialise, read_silver


class Fb:
    """The football view's tables, before landing."""

    def __init__(self, spark, sf_dir):
        root = materialise(spark, sf_dir)
        self.ev, self.matches, self.lineups = (read_silver(spark, root, n) for n in ("events", "matches", "lineups"))


def test_sparse_types_union(spark):
    # part 1: n long; part 2: n double; part 3: no n -- mergeSchema alone fails on this
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    spark.createDataFrame([(1, 5)], "id long, n long").write.parquet(f"{root}/p1")
    spark.createDataFrame([(2, 2.5)], "id long, n double").write.parquet(f"{root}/p2")
    spark.createDataFrame([(3, "x")], "id long, other string").write.parquet(f"{root}/p3")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.DoubleType())])
    df = br.read_sparse_union(spark, [f"{root}/p1", f"{root}/p2", f"{root}/p3"], schema)
    got = sorted((r.id, r.n, r.other) for r in df.collect())
    assert got == [(1, 5.0, None), (2, 2.5, None), (3, None, "x")]


def test_nan_values_become_null(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (None, None), (7.0, "Leo")], "f double, s string")
    got = [(r[0], r[1]) for r in df.select(sv.float_id_to_long(F.col("f")), sv.nan_text_to_null(F.col("s"))).collect()]
    assert got == [(None, None), (None, None), (7, "Leo")]


def _only(t, cond):
    """The view's tables for the matches that fulfil a condition."""
    ids = t.matches.where(cond).select("match_id")
    return {"events": t.ev.join(ids, "match_id", "left_semi").select(*t.ev.columns),
            "lineups": t.lineups.join(ids, "match_id", "left_semi").select(*t.lineups.columns),
            "matches": t.matches.where(cond)}


def _events(spark, root, **kw):
    return sorted((r.match_id, r.id) for r in br.read_bronze_events(spark, root, **kw).select("match_id", "id").collect())


def test_incremental_landing_is_idempotent(spark):
    t = Fb(spark, SF0001)
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    # partial_match: events landed for everything, lineups and metadata only for 2022
    br.land_events(t.ev, root)
    br.land_lineups(t.lineups.where(F.col("season_year") == 2022), root)
    br.land_matches(t.matches.where(F.col("season_year") == 2022), root)
    assert br.complete_matches(spark, root).count() == 0  # nothing counts before the manifest
    br.commit(spark, root)
    pending = br.pending_matches(t.matches, br.complete_matches(spark, root))
    want = {r.match_id for r in t.matches.where(F.col("season_year") != 2022).collect()}
    assert {r.match_id for r in pending.collect()} == want and want
    # land the rest; a re-run then finds nothing to do
    assert br.land_run(_only(t, F.col("season_year") != 2022), root) == 1
    assert br.pending_matches(t.matches, br.complete_matches(spark, root)).count() == 0
    assert _events(spark, root) == sorted((r.match_id, r.event_id) for r in t.ev.collect())


def test_a_later_landing_keeps_what_was_landed(spark):
    """One match, then another of the same competition and season, then the first again."""
    t = Fb(spark, SF0001)
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    same = t.matches.groupBy("competition_folder_name", "season_year").agg(F.sort_array(F.collect_list("match_id")).alias("m")).orderBy(F.size("m").desc()).first()
    one, two = same.m[0], same.m[1]
    sizes = {r.match_id: r["count"] for r in t.ev.groupBy("match_id").count().collect()}
    players = {r.match_id: r["count"] for r in t.lineups.groupBy("match_id").count().collect()}
    for epoch, m in enumerate((one, two, one)):
        assert br.land_run(_only(t, F.col("match_id") == m), root) == epoch
        landed = {m for m in (one, two)[: epoch + 1]}
        got = {r.match_id: r["count"] for r in br.read_bronze_events(spark, root).groupBy("match_id").count().collect()}
        assert got == {m: sizes[m] for m in landed}
        flat = br.flatten_lineups(br.read_lineups(spark, root))
        assert {r.match_id: r["count"] for r in flat.groupBy("match_id").count().collect()} == {m: players[m] for m in landed}
        assert {r.match_id for r in br.read_matches(spark, root).collect()} == landed
    assert len(_events(spark, root, committed=False)) == 2 * sizes[one] + sizes[two]
    import pytest
    with pytest.raises(ValueError):  # a committed epoch is never written again
        br.land_events(t.ev, root, 0)
    # a run that crashed before its commit is tried again in its own epoch
    br.land_events(_only(t, F.col("match_id") == two)["events"], root, 3)
    assert br.epochs.next_epoch(spark, root) == 4
    assert br.land_run(_only(t, F.col("match_id") == two), root, 3) == 3
    assert len(_events(spark, root)) == sizes[one] + sizes[two]


def test_files_of_one_folder_with_other_columns_and_types(spark):
    """Five column sets and drifting numbers inside one folder: no value is lost."""
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    rows = [("id long, n long, s string", [(1, 5, "a"), (2, None, "b")]), ("id int, n double", [(3, 2.5)]), ("id long", [(4,)]),
            ("id long, n int, extra long", [(5, 7, 8)]), ("id long, extra double, more array<int>", [(6, 0.5, [1, 2])]),
            ("id long, more array<double>", [(7, [0.5])])]
    for schema, some in rows:
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(f"{root}/p")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.DoubleType()), T.StructField("s", T.StringType()),
                           T.StructField("never", T.IntegerType())])
    for late in (False, True):
        got = br.read_sparse_union(spark, [f"{root}/p"], schema)
        assert dict(got.dtypes) == {"id": "bigint", "n": "double", "s": "string", "never": "int", "extra": "double", "more": "array<double>",
                                    **({"late": "int"} if late else {})}
        assert sorted(map(tuple, got.select("id", "n", "s", "never", "extra", "more").collect())) == [
            (1, 5.0, "a", None, None, None), (2, None, "b", None, None, None), (3, 2.5, None, None, None, None), (4, None, None, None, None, None),
            (5, 7.0, None, None, 8.0, None), (6, None, None, None, 0.5, [1.0, 2.0]), (7, None, None, None, None, [0.5])]
        # a new file is seen: the footers known are those of the same files
        spark.createDataFrame([], "id long, s string, late int").write.mode("append").parquet(f"{root}/p")


def _local(path):
    return path.removeprefix("file:")


def _drop(spark, t, folder):
    br.raw_events(t.ev).repartition("match_id").write.partitionBy("match_id").parquet(f"{folder}/events")
    br.nest_lineups(t.lineups).repartition("match_id").write.partitionBy("match_id").parquet(f"{folder}/lineups")
    br.raw_matches(t.matches).write.parquet(f"{folder}/matches")


def test_unreadable_files_are_isolated(spark):
    import glob

    t = Fb(spark, SF0001)
    drop, root = (shared_scratch(spark, f"test/{uuid.uuid4().hex}") for _ in range(2))
    _drop(spark, t, drop)
    sizes = {r.match_id: r["count"] for r in t.ev.groupBy("match_id").count().collect()}
    cut = glob.glob(f"{_local(drop)}/events/match_id=0/*.parquet")[0]
    with open(cut, "rb") as f:
        whole = f.read()
    with open(cut, "wb") as f:  # a cut file: its footer is gone
        f.write(whole[: len(whole) // 2])
    os.remove(glob.glob(f"{_local(drop)}/events/match_id=0/.*.crc")[0])
    torn = glob.glob(f"{_local(drop)}/events/match_id=1/*.parquet")[0]
    with open(torn, "r+b") as f:  # its footer is whole, its pages aren't
        f.seek(4)
        f.write(b"\xff" * 2000)
    os.remove(glob.glob(f"{_local(drop)}/events/match_id=1/.*.crc")[0])
    epoch = br.land_incoming(spark, drop, root)
    bad = {(r.match_id, r.dataset): (r.path, r.reason) for r in spark.read.parquet(f"{root}/quarantine/epoch={epoch}").collect()}
    assert {m for m, _ in bad} == {0, 1}
    path, reason = bad[0, "events"]
    assert len([k for k in bad if k[0] == 0]) == 1 and path.endswith(os.path.basename(cut)) and reason.startswith("unreadable footer")
    assert bad[1, "events"][1].startswith("rows lost")
    good = {m: n for m, n in sizes.items() if m not in (0, 1)}
    assert {r.match_id: r["count"] for r in br.read_bronze_events(spark, root).groupBy("match_id").count().collect()} == good
    assert {r.match_id for r in br.read_matches(spark, root).collect()} == {r.match_id for r in br.read_lineups(spark, root).collect()} == set(good)
    # the next drop brings the files whole
    again = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    _drop(spark, t, again)
    assert br.land_incoming(spark, again, root) == epoch + 1
    assert len(_events(spark, root)) == sum(sizes.values())
    assert spark.read.parquet(f"{root}/quarantine/epoch={epoch + 1}").count() == 0


def test_silver_events_round_trip(spark):
    t = Fb(spark, SF0001)
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    br.land_events(t.ev, root)
    silver = sv.stg_events(br.read_bronze_events(spark, root, committed=False))
    cols = [c for c in t.ev.columns if c not in ("home_team", "away_team")]
    assert len(silver.columns) == 104 + 3
    a = sorted(tuple(r) for r in silver.select(*cols).collect())
    b = sorted(tuple(r) for r in t.ev.select(*cols).collect())
    assert a == b


def test_streaming_landing_is_exactly_once_with_overlapping_drops(spark):
    from pitchline.streaming import landing
    t = Fb(spark, SF0001)
    base = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    ev = t.ev.drop("ts")
    # both drops in ONE batch, overlapping on the 2022 matches, each split over several files
    ev.where(F.col("season") == 2022).repartition(3).write.parquet(f"{base}/in/drop=1")
    ev.repartition(4).write.parquet(f"{base}/in/drop=2")
    # all files in one batch, and one file per batch
    for files in (1000, 1):
        landing.start_landing(spark, f"{base}/in/drop=*", ev.schema, f"{base}/out{files}", f"{base}/ckpt{files}",
                              files_per_batch=files).awaitTermination()
        out = landing.read_landed(spark, f"{base}/out{files}")
        assert out.count() == ev.count() == out.select("event_id").distinct().count()


def test_unlisted_kinds_and_null_kinds_are_landed(spark):
    t = Fb(spark, SF0001)
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    kind = F.when(F.col("event_type") == "Duel", "Half Start").when(F.col("event_type") != "Dribble", F.col("event_type"))
    ev = t.ev.withColumn("event_type", kind)
    br.land_events(ev, root)
    for back in (br.read_bronze_events(spark, root, committed=False), br.read_bronze_merged(spark, root, committed=False)):
        got = {r["type"]: r["count"] for r in back.groupBy("type").count().collect()}
        want = {r["event_type"]: r["count"] for r in ev.groupBy("event_type").count().collect()}
        assert got == want and "Half Start" in got and None in got
    lost = back.where("type = 'Half Start'").select("duel_type").distinct().count()
    assert lost == 2  # unlisted kinds keep every column


def test_missing_group_raises_and_empty_group_does_not(spark):
    import pytest
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    spark.createDataFrame([(1, 5)], "id long, n long").write.parquet(f"{root}/p1")
    os.makedirs(f"{root.removeprefix('file:')}/p2")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])
    assert br.read_sparse_union(spark, [f"{root}/p1", f"{root}/p2"], schema).count() == 1
    with pytest.raises(Exception):
        br.read_sparse_union(spark, [f"{root}/p1", f"{root}/gone"], schema).count()


def test_written_event_files_are_sorted_by_match(spark):
    import glob

    import pyarrow.parquet as pq

    t = Fb(spark, SF0001)
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    br.land_events(t.ev, root)
    files = glob.glob(f"{root.removeprefix('file:')}/events/**/*.parquet", recursive=True)
    files += glob.glob(f"{materialise(spark, SF0001).removeprefix('file:')}/events/**/*.parquet", recursive=True)
    assert len(files) > 10
    for f in files:
        m = pq.ParquetFile(f).read(columns=["match_id"])["match_id"].to_pylist()
        assert m == sorted(m)


def test_streaming_landing_keeps_rows_without_id_and_equal_ids_of_matches(spark):
    from pitchline.streaming import landing
    base = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    schema = "event_id long, match_id long, competition string, season int, v int"
    for drop, rows in enumerate([[(1, 10, "c", 1, 1), (1, 11, "c", 1, 2), (1, 10, "c", 1, 1), (None, 10, "c", 1, 3)],
                                 [(1, 10, "c", 1, 1), (2, 10, "c", 1, 4), (None, 10, "c", 1, 3), (None, 10, "c", 1, 5), (3, None, "c", 1, 6)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/in/drop={drop}")
    start = landing.start_landing(spark, f"{base}/in/drop=*", T._parse_datatype_string(schema), f"{base}/out", f"{base}/ckpt", files_per_batch=1)
    start.awaitTermination()
    got = sorted((r.match_id, r.event_id, r.v) for r in landing.read_landed(spark, f"{base}/out").collect())
    assert got == [(10, 1, 1), (10, 2, 4), (11, 1, 2)]
    refused = sorted((r.v, r.reason) for r in landing.read_refused(spark, f"{base}/out").collect())
    assert refused == [(3, "missing event_id"), (3, "missing event_id"), (5, "missing event_id"), (6, "missing match_id")]


def test_a_rewritten_nested_file_changes_the_fingerprint(spark, tmp_path):
    import os

    from pitchline.sources.warehouse import input_fingerprint
    (tmp_path / "in" / "a").mkdir(parents=True)
    f = tmp_path / "in" / "a" / "part"
    f.write_text("one")
    before = input_fingerprint(spark, str(tmp_path / "in"))
    f.write_text("two")
    os.utime(f, (1, 1))
    assert input_fingerprint(spark, str(tmp_path / "in")) != before


def test_publishing_keeps_the_first_copy(spark, tmp_path):
    from pitchline.sources.warehouse import _publish
    for name in ("t1", "t2"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x").write_text(name)
    _publish(spark, str(tmp_path / "t1"), str(tmp_path / "final"))
    _publish(spark, str(tmp_path / "t2"), str(tmp_path / "final"))
    assert (tmp_path / "final" / "x").read_text() == "t1" and not (tmp_path / "t2").exists()
    assert [p.name for p in (tmp_path / "final").iterdir() if not p.name.startswith(".")] == ["x"]


def test_no_local_folder_on_a_cluster():
    import pytest

    from pitchline.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_bad_match_dates_are_quarantined_not_fatal(spark):
    raw = spark.createDataFrame(
        [(1, "c", 2024, "2024-06-14", "H", "A", 1.0, 0.0, "Final", "nan", float("nan"), "1950-01-02"),
         (2, "c", 2024, "14/06/2024", "H", "B", 0.0, 0.0, "Final", "Ref", 4.0, None),
         (3, "c", 2024, "2024-06-15", None, "B", 0.0, 2.0, "Final", "Ref", 4.0, None)],
        "match_id long, competition_folder_name string, season_year int, match_date string, "
        "home_team_name string, away_team_name string, home_score double, away_score double, "
        "competition_stage_name string, referee string, referee_id double, home_manager_dob string")
    raw = raw.withColumns({"away_manager_dob": F.lit(None).cast("string"), "last_updated": F.lit("2024-01-01T10:00:00.250000"),
                           "referee_country_id": F.lit(3.0), "home_manager_nickname": F.lit("nan"),
                           "away_manager_nickname": F.lit("Nick")})
    late = raw.where("match_id = 1")
    more = late.withColumns({"match_id": F.lit(4).cast("long"), "home_manager_dob": F.lit("1950")}).unionByName(
        late.withColumns({"match_id": F.lit(5).cast("long"), "away_manager_dob": F.lit("no date")})).unionByName(
        late.withColumns({"match_id": F.lit(6).cast("long"), "last_updated": F.lit("yesterday")}))
    _, others = sv.split_matches(more.withColumn("home_manager_dob", F.when(F.col("match_id") == 4, "195x").otherwise(F.col("home_manager_dob"))))
    assert sorted((r.match_id, r.reject_reason) for r in others.collect()) == [
        (4, "bad_home_manager_dob"), (5, "bad_away_manager_dob"), (6, "bad_last_updated")]
    good, bad = sv.split_matches(raw)
    g = good.collect()
    assert [(r.match_id, str(r.match_date), r.home_score, r.referee_name, r.referee_id, str(r.home_manager_dob),
             r.home_manager_nickname, r.away_manager_nickname, str(r.last_updated_at)) for r in g] == [
        (1, "2024-06-14", 1, None, None, "1950-01-02", None, "Nick", "2024-01-01 10:00:00.250000")]
    assert sorted((r.match_id, r.reject_reason) for r in bad.collect()) == [(2, "bad_match_date"), (3, "missing_team")]


def test_staged_event_columns_against_rows_written_by_hand(spark):
    """Renames, flags, casts and coordinates of staging, stated value by value."""
    schema = T.StructType([*br.BRONZE_EVENT_SCHEMA.fields, T.StructField("type", T.StringType()), T.StructField("competition", T.StringType()),
                           T.StructField("season", T.IntegerType())])
    nan = float("nan")
    given = [{"id": 7, "match_id": 3, "period": 1, "minute": 2, "second": 3, "possession": 4, "team": "H", "player_id": 11.0, "player": "Ann",
              "position": "Goalkeeper", "play_pattern": "From Kick Off", "location": [60.5, 40.0], "type": "Pass", "competition": "c", "season": 2024,
              "pass_end_location": [71.0, 30.0], "pass_assisted_shot_id": 9.0, "pass_shot_assist": True, "pass_recipient_id": 12.0, "out": True,
              "50_50": None, "pass_recipient": "Bea", "index": 5},
             {"id": 8, "match_id": 3, "player_id": nan, "pass_assisted_shot_id": nan, "type": "Shot", "shot_expected_goals": 0.25,
              "shot_end_location": [118.0, 39.0, 1.5], "location": [110.0], "competition": "c", "season": 2024},
             {"id": 9, "match_id": 3, "type": "Carry", "carry_end_location": [50.0, 20.0], "counterpress": True, "competition": "c", "season": 2024}]
    raw = spark.createDataFrame([tuple(g.get(f.name) for f in schema.fields) for g in given], schema)
    staged = sv.stg_events(raw)
    flags = [f.name for f in staged.schema.fields if isinstance(f.dataType, T.BooleanType)]
    assert len(flags) == 37 and not [c for c in staged.columns if c in ("id", "type", "player", "out", "50_50", "index", "shot_expected_goals")]
    one, two, three = (r.asDict() for r in staged.orderBy("event_id").collect())
    assert (one["event_id"], one["event_type"], one["player_name"], one["player_position"], one["possession_sequence"], one["event_index"]) == (
        7, "Pass", "Ann", "Goalkeeper", 4, 5)
    assert (one["player_id"], one["pass_assisted_shot_id"], one["pass_recipient_id"], one["pass_recipient_name"]) == (11, 9, 12, "Bea")
    assert (one["start_x"], one["end_x"], one["pass_end_location_x"], one["pass_end_location_y"], one["location"]) == (60.5, 71.0, 71.0, 30.0, [60.5, 40.0])
    assert {f for f in flags if one[f]} == {"pass_shot_assist", "is_out"} and all(one[f] is False for f in flags if not one[f])
    assert (two["player_id"], two["pass_assisted_shot_id"], two["xg"], two["start_x"], two["end_x"]) == (None, None, 0.25, 110.0, None)
    assert (two["shot_end_location_x"], two["shot_end_location_y"], two["shot_end_location_z"]) == (118.0, 39.0, 1.5)
    assert not any(two[f] for f in flags) and {f for f in flags if three[f]} == {"counterpress"}
    assert (three["end_x"], three["carry_end_location_x"], three["start_x"]) == (50.0, 50.0, None)


def _rows_of_files(folder):
    import glob

    import pyarrow.parquet as pq

    return [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{folder.removeprefix('file:')}/**/*.parquet", recursive=True)]


def test_no_landing_task_holds_more_rows_as_a_kind_grows(spark):
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    ev = Fb(spark, SF0001).ev.withColumn("event_type", F.lit("Pass")).withColumn("competition", F.lit("c")).withColumn("season", F.lit(1))
    br.land_raw_events(br.raw_events(ev), root, rows_per_task=100)
    files = _rows_of_files(f"{root}/events/epoch=0/type=Pass")
    assert sum(files) == ev.count() == 1000
    assert max(files) <= 200  # a task's rows, not those of all spread files that fit a split
    assert br.read_bronze_events(spark, root, committed=False).select("id").distinct().count() == 1000


def test_no_streaming_task_holds_more_rows_as_a_batch_grows(spark, monkeypatch):
    from pitchline.streaming import landing
    monkeypatch.setattr(landing, "ROWS_PER_TASK", 50)
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    batch = Fb(spark, SF0001).ev.drop("ts").withColumn("competition", F.lit("c")).withColumn("season", F.lit(1)).coalesce(1)
    landing.land_batch(batch, 0, root)
    files = _rows_of_files(f"{root}/events")
    assert sum(files) == 1000 and max(files) <= 100


def test_matches_are_grouped_in_a_hash_table_before_texts_are_compared(spark):
    from pitchline.sources import fb
    ev = Fb(spark, SF0001).ev
    plan = fb.fb_matches(ev)._jdf.queryExecution().sparkPlan().toString()
    aggregates = [x.strip(" :+-") for x in plan.splitlines() if "Aggregate" in x]
    assert aggregates[-1].startswith("HashAggregate")  # next to the events
    two = ev.where("match_id = 0").withColumn("competition", F.when(F.col("event_id") % 2 == 0, "b").otherwise("a"))
    one, both = fb.fb_matches(ev.where("match_id = 0")).first(), fb.fb_matches(two).collect()
    assert [r.competition_folder_name for r in both] == ["a"]  # the least, and one row a match
    assert both[0].asDict() | {"competition_folder_name": 0} == one.asDict() | {"competition_folder_name": 0}


def test_staged_input_is_dealt_out_by_rows(spark):
    from pitchline.session import dealt
    rows = spark.range(1000).coalesce(1)
    parts = dealt(rows, 1000, ["id"], 100).rdd.glom().map(len).collect()
    assert len(parts) == 10 and max(parts) <= 200
    assert dealt(rows, 100, ["id"], 100) is rows


def test_the_manifest_is_counted_by_many_tasks(spark, monkeypatch):
    from pyspark.sql import DataFrame

    from pitchline.sources import epochs
    monkeypatch.setattr(DataFrame, "coalesce", lambda *_: 1 / 0)  # one task would hold every partition's hash tables
    root = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    counts = {d: spark.range(50).selectExpr("id AS match_id", "id % 3 AS rows") for d in epochs.DATASETS}
    assert sorted(r.match_id for r in epochs.commit(spark, root, 0, counts).collect()) == [i for i in range(50) if i % 3]


def test_a_bucket_holds_no_more_rows_than_a_task():
    from pitchline.session import ROWS_PER_TASK
    from pitchline.sources import warehouse
    assert warehouse.BUCKET_ROWS <= ROWS_PER_TASK  # a bucket is a task that sorts its rows


def test_a_match_a_file_is_dealt_by_files(spark):
    """200 matches of one row each are written by several tasks, however few bytes they have."""
    import glob

    folder = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    br.drop_by_match(spark.range(200).select(F.col("id").alias("match_id"), F.lit(1).alias("n")), folder, 200)
    files = glob.glob(f"{_local(folder)}/match_id=*/part-*.parquet")
    assert len(files) == 200 and len({os.path.basename(f).split("-")[1] for f in files}) == 4
    known = footers.footers(spark, folder)
    assert len(known.rows) == 200 and [s.names for s in known.schemas.values()] == [["n"]] and len(known.groups) == 1


def test_data_files_are_those_of_hadoops_listing(spark):
    folder = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    spark.range(3).select("id", F.lit("a b%/é").alias("part")).write.partitionBy("part").parquet(folder)
    local = _local(folder)
    os.makedirs(f"{local}/empty/part=none")
    open(f"{local}/cut.parquet", "w").close()
    p, fs = br.epochs.path_of(spark, folder)
    listed, found = fs.listFiles(p, True), []
    while listed.hasNext():
        f = listed.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    assert footers.data_files(spark, folder) == sorted(found) and len(found) > 1
    assert footers.data_files(spark, found[0][0]) == [found[0]]
    with pytest.raises(FileNotFoundError):
        footers.data_files(spark, f"{folder}/missing")


def test_groups_are_read_by_folder_where_no_other_group_lies():
    root = "file:/d"
    a = [f"{root}/match_id={i}/x.parquet" for i in range(5)]
    b = [f"{root}/match_id=1/y.parquet"]
    assert footers._folders(a, a, root) == [root]
    assert footers._folders(a, a + b, root) == [f"{root}/match_id=0", a[1], *[f"{root}/match_id={i}" for i in range(2, 5)]]
    assert footers._folders(b, a + b, root) == b
    hidden = [f"{root}/.old/x.parquet"]
    assert footers._folders(hidden, hidden, root) == hidden  # Spark lists no hidden folder


def test_mixed_folders_are_read_whole_and_once(spark):
    """Two groups side by side, one file cut: every other file's rows once, with the folders' values."""
    import glob

    folder = shared_scratch(spark, f"test/{uuid.uuid4().hex}")
    both = spark.range(40).select(F.col("id").alias("n"), (F.col("id") % 8).alias("match_id"))
    both.repartition(1).write.partitionBy("match_id").parquet(folder)
    both.where("match_id in (2, 3)").withColumn("n", F.col("n") + 100.5).repartition(1).write.mode("append").partitionBy("match_id").parquet(folder)
    cut = glob.glob(f"{_local(folder)}/match_id=5/*.parquet")[0]
    with open(cut, "wb") as f:
        f.write(b"PAR1 cut")
    for skip_corrupt in (False, True):
        rows = footers.read_groups(spark, folder, T.StructType([]), folder, True, {"match_id": "long"}, skip_corrupt=skip_corrupt)
        got = sorted((r.n, r.match_id) for r in rows.collect())
        assert got == sorted([(float(i), i % 8) for i in range(40) if i % 8 != 5] + [(i + 100.5, i % 8) for i in range(40) if i % 8 in (2, 3)])
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    assert spark.conf.get(key) == "10000"
