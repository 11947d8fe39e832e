"""Property test: the Spark timeline against a brute-force simulation on random matches.

For every generated match the brute force walks the clock second by second: the score in force at
second t counts every goal at or before t, the match ends at its last event, segments are
half-open. It checks state minutes per team, the state of every event, and the invariants
(each team's minutes sum to the match length; A's Winning = B's Losing).
"""

import random

from conftest import ev_row, goal
from pitchline.operators import timeline as tl
from pitchline.plans import gamestate as gs


def brute_force(events, goals, end):
    """events: [(id, team, t)], goals: [(team, t)] -> (minutes by (team, state), state by id)."""
    def score_at(t):
        h = sum(1 for g, s in goals if g == "H" and s <= t)
        a = sum(1 for g, s in goals if g == "A" and s <= t)
        return h, a

    def state(team, h, a):
        me, them = (h, a) if team == "H" else (a, h)
        return "Winning" if me > them else "Losing" if me < them else "Drawing"

    secs = {}
    for t in range(end):                       # [0, end) second by second
        h, a = score_at(t)
        for team in ("H", "A"):
            k = (team, state(team, h, a))
            secs[k] = secs.get(k, 0) + 1
    states = {}
    for i, team, t in events:
        if t < end:
            states[i] = state(team, *score_at(t))
    return {k: v / 60.0 for k, v in secs.items()}, states


def test_random_matches_against_brute_force(make_events, make_matches):
    rng = random.Random(7)
    rows, expected_min, expected_state, ids = [], {}, {}, []
    eid = 0
    for m in range(1, 13):
        end = rng.randint(60, 400)                       # seconds; period 1 only
        n_goals = rng.choice([0, 1, 2, 3, 5])
        goal_t = [rng.choice([0, end, rng.randint(0, end)]) for _ in range(n_goals)]
        if n_goals >= 2 and rng.random() < 0.5:
            goal_t[1] = goal_t[0]                        # same-second goals
        goals = [(rng.choice("HA"), t) for t in goal_t]
        evs = [(rng.choice("HA"), rng.randint(0, end)) for _ in range(rng.randint(3, 15))] + [("H", end)]
        ev_list = []
        for team, t in evs:
            eid += 1
            rows.append(ev_row(eid, m, 1, t // 60, t % 60, "Pass", team))
            ev_list.append((eid, team, t))
        for team, t in goals:
            eid += 1
            rows.append(goal(eid, m, 1, t // 60, t % 60, team))
            ev_list.append((eid, team, t))
        mins, states = brute_force(ev_list, goals, end)
        for (team, st), v in mins.items():
            expected_min[(m, team, st)] = v
        expected_state.update(states)
        ids.append(m)
    ev, matches = make_events(rows), make_matches(ids)
    timed, _, frame, timeline, per_team = gs.timeline_parts(ev, matches)
    got_min = {(r.match_id, r.team, r.game_state): r.minutes_in_state
               for r in tl.state_durations(per_team).collect() if r.minutes_in_state > 0}
    assert got_min == {k: v for k, v in expected_min.items() if v > 0}
    got_state = {r.event_id: r.game_state for r in tl.attribute_events(timed, timeline, frame).collect()}
    assert got_state == expected_state
    # invariants: per team the states tile the match; A's Winning equals B's Losing
    for m in ids:
        for team, other in (("H", "A"), ("A", "H")):
            assert abs(sum(v for (mm, t, _), v in got_min.items() if mm == m and t == team)
                       - sum(v for (mm, t, _), v in got_min.items() if mm == m and t == other)) < 1e-9
            assert got_min.get((m, team, "Winning"), 0) == got_min.get((m, other, "Losing"), 0)
