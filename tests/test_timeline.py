"""Micro fixtures for the score timeline and game-state attribution (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from conftest import ev_row, goal
from pitchline.operators import timeline as tl
from pitchline.plans import gamestate as gs


def durations(ev, matches):
    _, _, _, _, per_team = gs.timeline_parts(ev, matches)
    return {(r.match_id, r.team, r.game_state): r.minutes_in_state
            for r in tl.state_durations(per_team).collect()}


def states(ev, matches, attribute="after"):
    timed, _, frame, timeline, _ = gs.timeline_parts(ev, matches)
    return {r.event_id: r.game_state
            for r in tl.attribute_events(timed, timeline, frame, attribute).collect()}


def test_no_goal_match_is_one_drawing_segment(make_events, make_matches):
    ev = make_events([ev_row(1, 1, 1, 0, 0), ev_row(2, 1, 2, 10, 0, team="A")])
    d = durations(ev, make_matches([1]))
    assert d == {(1, "H", "Drawing"): 55.0, (1, "A", "Drawing"): 55.0}


def test_goal_at_zero_and_at_end(make_events, make_matches):
    # The 0-0 anchor and a goal at second 0 stay two segments; the goal at match end
    # opens a zero-length segment and its own event is dropped (half-open [start, end)).
    ev = make_events([goal(1, 1, 1, 0, 0, "H"), ev_row(2, 1, 1, 10, 0),
                      goal(3, 1, 2, 30, 0, "A")])
    d = durations(ev, make_matches([1]))
    assert d == {(1, "H", "Drawing"): 0.0, (1, "H", "Winning"): 75.0,
                 (1, "A", "Drawing"): 0.0, (1, "A", "Losing"): 75.0}
    s = states(ev, make_matches([1]))
    assert s == {1: "Winning", 2: "Winning"}


def test_same_second_goals_counted_once(make_events, make_matches):
    # Two home goals in one second give 2-0, not 4-0
    ev = make_events([ev_row(1, 1, 1, 0, 0), goal(2, 1, 1, 20, 0, "H"), goal(3, 1, 1, 20, 0, "H"),
                      goal(4, 1, 1, 30, 0, "A"), goal(5, 1, 1, 30, 0, "H"), ev_row(6, 1, 2, 0, 0)])
    _, _, _, timeline, _ = gs.timeline_parts(ev, make_matches([1]))
    rows = sorted((r.goal_seconds, r.home_score, r.away_score) for r in timeline.collect())
    assert rows == [(1200, 2, 0), (1800, 3, 1)]


def test_equaliser_and_lead_is_symmetric(make_events, make_matches):
    ev = make_events([ev_row(1, 1, 1, 0, 0), goal(2, 1, 1, 10, 0, "A"), goal(3, 1, 1, 20, 0, "H"),
                      goal(4, 1, 1, 30, 0, "H"), ev_row(5, 1, 1, 50, 0, team="A")])
    m = make_matches([1])
    d = durations(ev, m)
    assert d[(1, "H", "Losing")] == 10.0 and d[(1, "A", "Winning")] == 10.0
    assert d[(1, "H", "Winning")] == 20.0 and d[(1, "A", "Losing")] == 20.0
    assert d[(1, "H", "Drawing")] == 20.0 and d[(1, "A", "Drawing")] == 20.0
    from pitchline.plans.team_marts import match_sides
    _, _, _, _, per_team = gs.timeline_parts(ev, m)
    strict = gs.check_symmetry_strict(tl.state_durations(per_team), match_sides(m)).collect()
    assert len(strict) == 2 and all(r.win_lose_diff == 0.0 for r in strict)


def test_three_minute_gate_on_unrounded_minutes(spark, make_events, make_matches):
    rows = []
    for m, gap in ((4, 179), (5, 180)):   # a 2:59 lead and a 3:00 lead
        rows += [ev_row(m * 10 + 1, m, 1, 0, 0), goal(m * 10 + 2, m, 1, 10, 0, "H"),
                 goal(m * 10 + 3, m, 1, 10 + gap // 60, gap % 60, "A"), ev_row(m * 10 + 4, m, 1, 40, 0)]
    ev = make_events(rows)
    comps = spark.createDataFrame([("c", 2024, "C")], "competition_folder_name string, season_year int, "
                                  "competition_name string")
    mart = gs.mart_gamestate(ev, make_matches([4, 5]), comps)
    winning = {r.match_id for r in mart.where(F.col("game_state") == "Winning").collect()}
    assert winning == {5}


def test_stoppage_overlap_and_shootout(make_events, make_matches):
    # Period 1 at 47:00 lies after period 2 at 00:30 on the absolute clock; period 5 is ignored
    ev = make_events([ev_row(1, 1, 1, 47, 0), ev_row(2, 1, 2, 0, 30), ev_row(3, 1, 5, 0, 10)])
    timed, _, frame, _, _ = gs.timeline_parts(ev, make_matches([1]))
    assert frame.collect()[0].match_end_seconds == 2820
    assert sorted(r.abs_seconds for r in timed.collect()) == [2730, 2820]


def test_clock_conventions(make_events, make_matches):
    # The same events read as per-period or cumulative minutes
    ev = make_events([ev_row(1, 1, 1, 10, 0), ev_row(2, 1, 2, 50, 0)])
    per = gs.timeline_parts(ev, make_matches([1]), "per_period")[2].collect()[0]
    cum = gs.timeline_parts(ev, make_matches([1]), "cumulative")[2].collect()[0]
    assert per.match_end_seconds == 2700 + 3000 and cum.match_end_seconds == 3000


def test_attribution_before_or_after_goal(make_events, make_matches):
    # An event in the goal's second sees the new score by default, the old one on request
    ev = make_events([ev_row(1, 1, 1, 0, 0), goal(2, 1, 1, 10, 0, "H"), ev_row(3, 1, 1, 10, 0),
                      ev_row(4, 1, 1, 20, 0)])
    assert states(ev, make_matches([1]))[3] == "Winning"
    assert states(ev, make_matches([1]), "before")[3] == "Drawing"


def test_interval_join_matches_window_attribution(make_events, make_matches):
    ev = make_events([ev_row(1, 1, 1, 0, 0), goal(2, 1, 1, 10, 0, "H"), ev_row(3, 1, 1, 10, 0, team="A"),
                      goal(4, 1, 1, 15, 0, "A"), ev_row(5, 1, 1, 20, 0), ev_row(6, 1, 1, 30, 0)])
    m = make_matches([1])
    timed, _, frame, timeline, per_team = gs.timeline_parts(ev, m)
    pts = timed.select("event_id", "match_id", "team", F.col("abs_seconds").cast("double").alias("at"))
    ij = tl.interval_join(pts, per_team, ["match_id", "team"], "at")
    assert {r.event_id: r.game_state for r in ij.collect()} == states(ev, m)


def _brute_join(points, intervals):
    return sorted((p, i) for p, k, at in points for i, kk, s, e in intervals if k == kk and at is not None and s is not None and e is not None and s <= at < e)


def test_interval_join_of_ten_thousand_intervals_of_one_key(spark):
    """Long, short, nested and touching intervals of one key against brute force; the plan's join has
    the node in its keys, so no point meets all intervals of its key."""
    import random
    rng = random.Random(5)
    intervals = []
    for i in range(10_000):
        s = rng.randint(-50_000, 50_000)
        intervals.append((i, 1, float(s), float(s + rng.choice([0, 1, 2, 7, 8, 9, 64, 100, rng.randint(1, 500)]))))
    intervals += [(10_000, 1, -60_000.0, 60_000.0), (10_001, 2, 0.0, 10.0), (10_002, 1, None, 5.0), (10_003, 1, 5.0, None), (10_004, 1, float("nan"), 5.0)]
    points = [(p, 1, float(rng.randint(-50_100, 50_100))) for p in range(400)] + [(400, 2, 9.0), (401, 2, 10.0), (402, 1, None), (403, None, 1.0)]
    pts = spark.createDataFrame(points, "p long, k long, at double")
    ivs = spark.createDataFrame(intervals, "i long, k long, s double, e double")
    got = tl.interval_join(pts, ivs, ["k"], "at", "s", "e")
    assert sorted((r.p, r.i) for r in got.collect()) == _brute_join(points, intervals)
    join = next(line for line in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Join" in line)
    assert "node" in join.split("Inner")[0]


def test_interval_join_never_broadcasts_the_nodes_of_intervals(spark):
    pts = spark.createDataFrame([(1, 10.0)], "k int, at double")
    ivs = spark.createDataFrame([(1, 0.0, 6000.0)], "k int, s double, e double")
    joined = tl.interval_join(pts, ivs, ["k"], "at", "s", "e")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert joined.count() == 1


def test_states_of_events_are_merged_not_broadcast(make_events, make_matches):
    ev, matches = make_events([goal(1, 1, 1, 2, 0, "H"), ev_row(2, 1, 1, 3, 0), ev_row(3, 1, 1, 4, 0)]), make_matches([1])
    got = tl.state_of_events(tl.events_clock(ev), matches)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert {r.event_id: r.game_state for r in got.collect()} == {1: "Winning", 2: "Winning"}


def test_interval_join_with_fractions_and_other_cells(spark):
    import random
    rng = random.Random(6)
    intervals = [(i, 1, s, s + rng.choice([0.1, 0.5, 1.0, 3.7, 40.0])) for i, s in enumerate(round(rng.uniform(-30, 30), 2) for _ in range(300))]
    points = [(p, 1, round(rng.uniform(-40, 80), 2)) for p in range(300)] + [(900 + n, 1, iv[2]) for n, iv in enumerate(intervals[:20])] + [
        (950 + n, 1, iv[3]) for n, iv in enumerate(intervals[:20])]
    pts, ivs = spark.createDataFrame(points, "p long, k long, at double"), spark.createDataFrame(intervals, "i long, k long, s double, e double")
    for cell, fan in ((1.0, 8), (0.25, 2), (5.0, 3)):
        got = tl.interval_join(pts, ivs, ["k"], "at", "s", "e", cell, fan)
        assert sorted((r.p, r.i) for r in got.collect()) == _brute_join(points, intervals), (cell, fan)
    assert tl.interval_join(pts.limit(0), ivs, ["k"], "at", "s", "e").count() == tl.interval_join(pts, ivs.limit(0), ["k"], "at", "s", "e").count() == 0


def test_overlap_join_gives_each_pair_once(spark):
    import random
    rng = random.Random(7)

    def some(n):
        return [(i, rng.randint(1, 2), float(s), float(s + rng.randint(0, 30))) for i, s in enumerate(rng.randint(0, 300) for _ in range(n))]

    a, b = some(150), some(150)
    left = spark.createDataFrame(a, "i long, k long, seg_start double, seg_end double")
    right = spark.createDataFrame(b, "j long, k long, seg_start double, seg_end double")
    got = sorted((r.left.i, r.right.j) for r in tl.overlap_join(left, right, ["k"]).collect())
    want = sorted((i, j) for i, k, s, e in a for j, kk, s2, e2 in b if k == kk and s < e and s2 < e2 and max(s, s2) < min(e, e2))
    assert got == want and len(want) > 500


def test_mart_states_before_and_after_a_goal(spark, make_events, make_matches):
    ev = make_events([ev_row(1, 1, 1, 0, 0), goal(2, 1, 1, 10, 0, "H"), ev_row(3, 1, 1, 10, 0), ev_row(4, 1, 1, 20, 0)])
    comps = spark.createDataFrame([("c", 2024, "C")], "competition_folder_name string, season_year int, competition_name string")
    for attribute, passes in (("after", {"Drawing": 1, "Winning": 1}), ("before", {"Drawing": 2, "Winning": 0})):
        mart = {(r.team_name, r.game_state): r for r in gs.mart_gamestate(ev, make_matches([1]), comps, attribute=attribute).collect()}
        assert {s: mart["H", s].passes_attempted for s in passes} == passes
        assert all(r.minutes_in_state == 10.0 for r in mart.values()) and set(mart) == {
            ("H", "Drawing"), ("A", "Drawing"), ("H", "Winning"), ("A", "Losing")}


def test_bucketed_seconds_need_no_exchange_by_match(spark):
    from conftest import SF0001
    from pitchline.plans.catalog import Tables, load_all

    q = load_all()
    bucketed = q["mart_gamestate_bucketed"](spark, SF0001)
    plan = bucketed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(match_id" not in plan and "SelectedBucketsCount" in plan
    assert sorted(map(str, bucketed.collect())) == sorted(map(str, q["mart_gamestate"](spark, SF0001).collect()))
    # another session's catalogue gets the table from its files
    from pitchline.sources import warehouse as w
    name = w.table_name(spark, SF0001, "seconds")
    rows = spark.table(name).count()
    spark.sql(f"DROP TABLE {name}")
    again = q["mart_gamestate_bucketed"](spark, SF0001)
    assert spark.table(name).count() == rows
    assert "hashpartitioning(match_id" not in again._jdf.queryExecution().executedPlan().toString()
    assert Tables(spark, SF0001).matches.count() > 0
