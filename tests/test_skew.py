"""A hot match (most of all events) must not become a hot window partition: the per-second table
that feeds every per-match window is bounded by the clock, whatever the event volume."""

from pyspark.sql import functions as F

from conftest import ev_row, goal
from pitchline.operators import timeline as tl
from pitchline.plans import gamestate as gs


def test_hot_match_is_bounded_by_the_clock(make_events, make_matches):
    rows, eid = [], 0
    # match 1: 20,000 events squeezed into 300 seconds; match 2: 50 events
    for m, n, span in ((1, 20000, 300), (2, 50, 300)):
        for j in range(n):
            eid += 1
            rows.append(ev_row(eid, m, 1, (j % span) // 60, (j % span) % 60, "Pass", "H" if j % 2 else "A"))
        eid += 1
        rows.append(goal(eid, m, 1, 2, 0, "H"))
    ev, matches = make_events(rows), make_matches([1, 2])
    timed, sec, frame, timeline, per_team = gs.timeline_parts(ev, matches, metrics=gs.state_metrics())
    per_match = {r.match_id: r.n for r in sec.groupBy("match_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_match[1] <= 2 * 300 and per_match[2] <= 2 * 300     # bounded by teams x seconds
    # and the states still come out right: the hot match's passes after the goal are Winning for H
    states = tl.attribute_events(timed, timeline, frame)
    after = states.where((F.col("match_id") == 1) & (F.col("abs_seconds") >= 120) & (F.col("team") == "H")
                         & (F.col("abs_seconds") < 299))
    assert after.where(F.col("game_state") != "Winning").count() == 0
    assert after.count() > 0
