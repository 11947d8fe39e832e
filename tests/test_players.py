"""Micro fixtures for the player mart: modal position ties, segments, xA edge cases."""

from conftest import ev_row
from pitchline.plans import players as pl

SEG = "array<struct<from:string,to:string,from_period:int,to_period:int>>"


def test_mode_tie_takes_smallest(make_events):
    rows = [ev_row(i, 1, 1, 0, i, player_id=7, player_name="P7",
                   player_position=("Right Wing" if i % 2 else "Left Wing")) for i in range(4)]
    out = pl.player_event_stats(make_events(rows)).collect()
    assert out[0].primary_position == "Left Wing"


def test_segments_minutes(spark):
    rows = [(1, 7, "H", "c", 2024, [("00:00", None, 1, None)]),                        # open -> 120:00
            (2, 7, "H", "c", 2024, [("00:00", "60:00", 1, 2), ("60:00", "75:30", 2, 2)]),
            (3, 7, "H", "c", 2024, []),                                               # dropped
            (4, 7, "H", "c", 2024, None)]                                             # dropped
    lu = spark.createDataFrame(rows, f"match_id long, player_id long, team_name string, "
                               f"competition_folder_name string, season_year int, positions {SEG}")
    pm = pl.player_minutes(lu).collect()[0]
    assert pm.matches_played == 2 and pm.total_minutes == 120.0 + 75.5
    segs = pl.lineup_segments(lu).collect()
    assert sorted(r.seg_seconds for r in segs) == [900 + 30, 3600, 7200]


def test_xa_skips_penalties_and_other_matches(make_events):
    rows = [ev_row(1, 1, 1, 0, 0, "Pass", player_id=5, pass_assisted_shot_id=2),
            ev_row(2, 1, 1, 0, 5, "Shot", xg=0.5),                                   # counted
            ev_row(3, 1, 1, 1, 0, "Pass", player_id=5, pass_assisted_shot_id=4),
            ev_row(4, 1, 1, 1, 5, "Shot", xg=0.75, shot_type="Penalty"),             # penalty
            ev_row(5, 1, 1, 2, 0, "Pass", player_id=5, pass_assisted_shot_id=6),
            ev_row(6, 2, 1, 0, 5, "Shot", xg=0.125),                                 # other match
            ev_row(7, 1, 1, 3, 0, "Pass", player_id=5, pass_assisted_shot_id=8),
            ev_row(8, 1, 1, 3, 5, "Shot", xg=0.25, shot_type=None)]                  # NULL type
    out = pl.expected_assists(make_events(rows)).collect()
    assert len(out) == 1 and out[0].total_xa == 0.5


def test_open_segment_can_end_at_match_end(spark):
    # A starter with an open segment in a match that ended at 94:30
    lu = spark.createDataFrame([(1, 7, "H", "c", 2024, [("00:00", None, 1, None)]),
                                (2, 7, "H", "c", 2024, [("10:00", None, 1, None)])],
                               f"match_id long, player_id long, team_name string, "
                               f"competition_folder_name string, season_year int, positions {SEG}")
    ends = spark.createDataFrame([(1, 94 * 60 + 30)], "match_id long, match_end_seconds long")
    by_default = pl.player_minutes(lu).collect()[0].total_minutes
    to_end = pl.player_minutes(lu, match_end=ends).collect()[0].total_minutes
    assert by_default == 120.0 + 110.0
    assert to_end == 94.5 + 110.0      # match 2 has no known end: falls back to 120:00


def test_facts_are_the_counts_and_assists_of_one_scan(spark, make_events):
    import random
    rng = random.Random(3)
    rows = []
    for i in range(1, 1200):
        kind = rng.choice(["Pass", "Shot", "Carry", "Dribble", "Pressure", "Ball Recovery"])
        rows.append(ev_row(i, rng.choice([1, 1, 1, 2]), 1, 0, 0, kind, team=rng.choice("HA"), player_id=rng.choice([None, 1, 2, 3]), player_name="x",
                           player_position=rng.choice([None, "A", "B"]), dribble_outcome=rng.choice(["Complete", None]),
                           shot_type=rng.choice(["Penalty", "Open Play", "Open Play", None]) if kind == "Shot" else None,
                           shot_outcome=rng.choice(["Goal", "Saved"]) if kind == "Shot" else None,
                           pass_assisted_shot_id=rng.randint(1, 1200) if kind == "Pass" and rng.random() < 0.7 else None))
    ev = make_events(rows)
    facts = ev.sparkSession.createDataFrame(pl.player_facts(ev).collect(), pl.player_facts(ev).schema)
    both = pl.player_event_stats(ev).join(pl.expected_assists(ev), pl.PLAYER_KEYS, "left").select(*facts.columns)
    assert sorted(map(str, facts.collect())) == sorted(map(str, both.collect()))
    assert any(r.total_xa for r in facts.collect())
    plan = pl.player_facts(ev.sparkSession.createDataFrame(ev.collect(), ev.schema))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
