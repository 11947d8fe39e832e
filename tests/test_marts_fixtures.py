"""Micro fixtures: own goal reconciliation (T12), dropped teams (T8), unknown stage."""

from pyspark.sql import functions as F

from conftest import ev_row, goal
from pitchline.plans import gamestate as gs
from pitchline.plans import outcomes
from pitchline.plans import team_marts as tm


def comps(spark):
    return spark.createDataFrame([("c", 2024, "C")],
                                 "competition_folder_name string, season_year int, competition_name string")


def test_own_goal_is_not_in_the_rebuilt_score(spark, make_events):
    # recorded 1-0, but the goal was not a shot: the rebuilt score stays 0-0
    ev = make_events([ev_row(1, 1, 1, 0, 0), ev_row(2, 1, 1, 30, 0, team="A")])
    matches = spark.createDataFrame(
        [(1, "H", "A", "c", 2024, "Final", 1, 0)],
        "match_id long, home_team_name string, away_team_name string, competition_folder_name string, "
        "season_year int, competition_stage_name string, home_score int, away_score int")
    _, _, frame, timeline, _ = gs.timeline_parts(ev, matches)
    assert timeline.count() == 0
    rebuilt = frame.join(timeline.groupBy("match_id").agg(F.max("home_score").alias("h")), "match_id", "left")
    row = rebuilt.join(matches, "match_id").select(F.coalesce("h", F.lit(0)).alias("h"), "home_score").first()
    assert (row.h, row.home_score) == (0, 1)


def test_drop_teams(spark, make_events, make_matches):
    rows = [
        # H: only a penalty shot -> no M1 row; one set-piece shot -> M4 row
        ev_row(1, 1, 1, 0, 0, "Shot", "H", shot_type="Penalty"),
        ev_row(2, 1, 1, 1, 0, "Shot", "H", play_pattern="From Corner"),
        # A: open-play shot only -> M1 row, no M4 row; A never passes in H's PPDA zone
        ev_row(3, 1, 1, 2, 0, "Shot", "A"),
        ev_row(4, 1, 1, 3, 0, "Pass", "H", start_x=50.0),
        ev_row(5, 1, 1, 4, 0, "Pass", "A", start_x=100.0),
        ev_row(6, 1, 1, 5, 0, "Pressure", "H", start_x=70.0),
    ]
    ev, m, c = make_events(rows), make_matches([1]), comps(spark)
    m1 = {r.team_name for r in tm.mart_attack_quality(ev, c).collect()}
    m4 = {r.team_name for r in tm.mart_set_piece(ev, c).collect()}
    m3 = {r.team_name for r in tm.mart_defensive_pressure(ev, m, c).collect()}
    assert m1 == {"A", "H"}      # H keeps its non-penalty set-piece shot
    assert "A" not in m4 and "H" in m4
    assert m3 == {"A"}          # H's opponent (A) has no pass at x <= 72, so H drops out


def test_penalty_only_team_drops_from_attack_mart(spark, make_events):
    ev = make_events([ev_row(1, 1, 1, 0, 0, "Shot", "H", shot_type="Penalty"),
                      ev_row(2, 1, 1, 1, 0, "Shot", "A")])
    assert {r.team_name for r in tm.mart_attack_quality(ev, comps(spark)).collect()} == {"A"}


def test_stage_unknown_has_no_class(spark):
    matches = spark.createDataFrame(
        [(1, "H", "A", "c", 2024, "Play-off", 0, 0), (2, "H", "B", "c", 2024, "Final", 0, 0)],
        "match_id long, home_team_name string, away_team_name string, competition_folder_name string, "
        "season_year int, competition_stage_name string, home_score int, away_score int")
    got = {r.team_name: (r.max_stage_rank, r.outcome_class) for r in outcomes.team_outcomes(matches).collect()}
    assert got == {"H": (6, "Finalist"), "A": (0, None), "B": (6, "Finalist")}


def test_opponent_passes_count_without_own_located_event(spark, make_events, make_matches):
    # match 1: H has a pressure and A one zone pass; match 2: H has no located event, A ten zone passes
    rows = [ev_row(1, 1, 1, 0, 0, "Pressure", "H", start_x=70.0), ev_row(2, 1, 1, 1, 0, "Pass", "A", start_x=50.0)]
    rows += [ev_row(10 + i, 2, 1, 2, i, "Pass", "A", start_x=50.0) for i in range(10)]
    rows += [ev_row(30, 2, 1, 3, 0, "Foul Committed", "H", start_x=None)]
    m3 = {r.team_name: r for r in tm.mart_defensive_pressure(make_events(rows), make_matches([1, 2]), comps(spark)).collect()}
    assert m3["H"].opp_passes_in_zone_raw == 11 and m3["H"].ppda == 11.0


def test_rows_without_a_team_drop_out(spark, make_events):
    ev = make_events([ev_row(1, 1, 1, 0, 0, "Shot", "H"), ev_row(2, 1, 1, 1, 0, "Shot", None)])
    assert {r.team_name for r in tm.mart_attack_quality(ev, comps(spark)).collect()} == {"H"}
