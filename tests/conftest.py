import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitchline.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app_name="pitchline-tests")
    yield s
    s.stop()


EVENT_SCHEMA = ("event_id long, match_id long, competition string, season int, period int, minute long, "
                "second long, event_type string, team string, start_x double, end_x double, "
                "pass_outcome string, xg double, shot_type string, shot_outcome string, "
                "player_id long, player_name string, player_position string, play_pattern string, "
                "pass_assisted_shot_id long, pass_shot_assist boolean, counterpress boolean, duel_type string, dribble_outcome string, "
                "possession_sequence long")

EVENT_COLS = [f.split()[0] for f in EVENT_SCHEMA.split(", ")]


def ev_row(event_id, match_id, period, minute, second, event_type="Pass", team="H", **kw):
    base = dict(event_id=event_id, match_id=match_id, competition="c", season=2024, period=period,
                minute=minute, second=second, event_type=event_type, team=team, start_x=50.0,
                end_x=60.0 if event_type in ("Pass", "Carry") else None, pass_outcome=None,
                xg=0.25 if event_type == "Shot" else None,
                shot_type="Open Play" if event_type == "Shot" else None,
                shot_outcome=None, player_id=None, player_name=None, player_position=None,
                play_pattern="Regular Play", pass_assisted_shot_id=None, pass_shot_assist=kw.get("pass_assisted_shot_id") is not None, counterpress=False,
                duel_type=None, dribble_outcome=None, possession_sequence=0)
    base.update(kw)
    return tuple(base[c] for c in EVENT_COLS)


def goal(event_id, match_id, period, minute, second, team, **kw):
    return ev_row(event_id, match_id, period, minute, second, "Shot", team, shot_outcome="Goal", **kw)


@pytest.fixture
def make_events(spark):
    def mk(rows):
        return spark.createDataFrame(rows, EVENT_SCHEMA)
    return mk


@pytest.fixture
def make_matches(spark):
    def mk(ids, home="H", away="A"):
        return spark.createDataFrame(
            [(m, home, away, "c", 2024, "Final", 0, 0) for m in ids],
            "match_id long, home_team_name string, away_team_name string, competition_folder_name string, "
            "season_year int, competition_stage_name string, home_score int, away_score int")
    return mk
