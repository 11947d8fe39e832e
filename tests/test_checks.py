"""Data-quality runner on a fixture with one violation per check type."""

from pyspark.sql import functions as F

from pitchline.operators import quality as dq


def test_bad_checks(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, None, "y"), (2, "b", "bad"), (3, "c", None)],
                               "id long, name string, kind string")
    specs = {"t": dq.TableChecks(not_null=["name", "id"], unique=["id"],
                                 accepted_values={"kind": ["x", "y"]})}
    got = {(r.check_name, r.column_name): r.failures for r in dq.run_checks({"t": df}, specs).collect()}
    assert got == {("not_null", "name"): 1, ("not_null", "id"): 0, ("unique", "id"): 1,
                   ("accepted_values", "kind"): 1}


def test_checks_are_observed_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (1, None, "y"), (2, "b", "bad"), (3, "c", None)],
                               "id long, name string, kind string").repartition(3)
    spec = dq.TableChecks(not_null=["name", "id"], unique=["id"], accepted_values={"kind": ["x", "y"]})
    seen = dq.write_observed("t", df, spec, lambda w: w.parquet(str(tmp_path / "t")))
    assert sorted(seen, key=str) == sorted([("t", "rows", None, 4), ("t", "not_null", "name", 1), ("t", "not_null", "id", 0),
                                            ("t", "accepted_values", "kind", 1)], key=str)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    assert dq.observed_table(spark, seen).where("check_name = 'rows'").first().failures == 4
    assert dq.write_observed("e", df.limit(0), spec, lambda w: w.parquet(str(tmp_path / "e")))[0] == ("e", "rows", None, 0)


def test_quarantine_split(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "not a date"), (None, "2024-02-01")],
                               "id long, d string")
    good, bad = dq.bad_record_split(df, {"missing_id": F.col("id").isNull(),
                                         "bad_date": F.try_to_timestamp("d").isNull()})
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad_date", "missing_id"]


def test_symmetry_checks_catch_a_broken_mart(spark):
    from pitchline.plans import gamestate as gs
    mart = spark.createDataFrame(
        [(1, "H", "Winning", 30.0), (1, "A", "Losing", 30.0),      # symmetric
         (2, "H", "Winning", 30.0), (2, "A", "Losing", 27.5),      # off by 2.5 minutes
         (3, "H", "Drawing", 90.0), (3, "A", "Drawing", 90.0)],    # no winner at all
        "match_id long, team_name string, game_state string, minutes_in_state double")
    bad = gs.check_symmetry(mart).collect()
    assert [(r.match_id, r.diff) for r in bad] == [(2, 2.5)]
    durations = mart.withColumnRenamed("team_name", "team")
    sides = spark.createDataFrame([(m, t, o) for m in (1, 2, 3) for t, o in (("H", "A"), ("A", "H"))],
                                  "match_id long, team string, opponent string")
    strict = {(r.match_id, r.team): r.win_lose_diff
              for r in gs.check_symmetry_strict(durations, sides).collect()}
    assert strict[(2, "H")] == 2.5 and strict[(1, "H")] == 0.0 and strict[(3, "H")] == 0.0
