"""Registered queries for the score timeline and the game-state mart (M6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchline.operators import timeline as tl
from pitchline.plans import gamestate as gs
from pitchline.plans.catalog import Tables, query
from pitchline.plans.team_marts import match_sides
from pitchline.sources.bronze import union_all
from pitchline.sources.warehouse import bucketed_by_match, table_name

col = F.col


@query("events_timed")
def q_events_timed(spark, sf):
    t = Tables(spark, sf)
    return tl.events_timed(t.ev, t.matches).select(
        "event_id", "match_id", "team", "event_type", "period", "minute", "second", "abs_seconds",
        "home_team", "away_team")


@query("events_measured_clock")
def q_events_measured_clock(spark, sf):
    return tl.measured_clock(Tables(spark, sf).ev).select("event_id", "match_id", "period", "measured_seconds")


@query("score_timeline")
def q_score_timeline(spark, sf):
    t = Tables(spark, sf)
    _, _, _, timeline, _ = gs.timeline_parts(t.ev, t.matches)
    return timeline


@query("score_segments")
def q_score_segments(spark, sf):
    t = Tables(spark, sf)
    _, _, _, _, per_team = gs.timeline_parts(t.ev, t.matches)
    return per_team


@query("state_durations")
def q_state_durations(spark, sf):
    t = Tables(spark, sf)
    _, _, _, _, per_team = gs.timeline_parts(t.ev, t.matches)
    return tl.state_durations(per_team)


@query("gamestate_events")
def q_gamestate_events(spark, sf):
    t = Tables(spark, sf)
    return tl.state_of_events(tl.events_clock(t.ev), t.matches).select(
        "event_id", "match_id", "team", "abs_seconds", "game_state")


@query("interval_join")
def q_interval_join(spark, sf):
    """General range join: every timed event to the segment of its team containing it."""
    t = Tables(spark, sf)
    timed, _, _, _, per_team = gs.timeline_parts(t.ev, t.matches)
    pts = timed.select("event_id", "match_id", "team", col("abs_seconds").cast("double").alias("at"))
    return tl.interval_join(pts, per_team.select("match_id", "team", "seg_start", "seg_end", "game_state"),
                            ["match_id", "team"], "at").select(
        "event_id", "match_id", "team", "seg_start", "seg_end", "game_state")


@query("mart_gamestate")
def q_mart_gamestate(spark, sf):
    t = Tables(spark, sf)
    return gs.mart_gamestate(t.ev, t.matches, t.comps)


def _seconds_table(t: Tables):
    return bucketed_by_match(t.spark, t.sf_dir, "seconds", lambda: tl.anchored(gs.mart_seconds(t.ev), t.matches), "abs_seconds")


@query("mart_gamestate_bucketed")
def q_mart_gamestate_bucketed(spark, sf):
    """M6 from the catalogue's per-second table, bucketed by match: no exchange by match."""
    t = Tables(spark, sf)
    return gs.mart_from_seconds(_seconds_table(t), None, t.comps)


@query("catalog_tables")
def q_catalog_tables(spark, sf):
    """The warehouse's tables as the session's catalogue lists them, with kind and rows."""
    t = Tables(spark, sf)
    _seconds_table(t)
    own = table_name(spark, sf, "seconds")
    names = [x.name for x in spark.catalog.listTables() if x.name == own and x.tableType == "EXTERNAL"]
    parts = [spark.table(n).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("match_id").alias("matches")).select(
        F.lit("seconds").alias("table_name"), F.lit("EXTERNAL").alias("kind"), "rows", "matches") for n in names]
    return union_all(parts)


@query("check_symmetry")
def q_check_symmetry(spark, sf):
    """The invariant test runs on the built mart table, as the original's data test does."""
    return gs.check_symmetry(Tables(spark, sf).m6())


@query("check_symmetry_strict")
def q_check_symmetry_strict(spark, sf):
    t = Tables(spark, sf)
    _, _, _, _, per_team = gs.timeline_parts(t.ev, t.matches)
    return gs.check_symmetry_strict(tl.state_durations(per_team), match_sides(t.matches))


@query("score_reconcile")
def q_score_reconcile(spark, sf):
    """Score rebuilt from the timeline vs the score recorded on the match row."""
    t = Tables(spark, sf)
    _, _, frame, timeline, _ = gs.timeline_parts(t.ev, t.matches)
    final = timeline.groupBy("match_id").agg(F.max("home_score").alias("rh"), F.max("away_score").alias("ra"))
    rec = t.matches.select("match_id", col("home_score").cast("long").alias("recorded_home"),
                           col("away_score").cast("long").alias("recorded_away"))
    j = frame.select("match_id").join(final, "match_id", "left").join(rec, "match_id", "inner")
    rh, ra = F.coalesce(col("rh"), F.lit(0)), F.coalesce(col("ra"), F.lit(0))
    return j.select("match_id", rh.cast("long").alias("rebuilt_home"), ra.cast("long").alias("rebuilt_away"),
                    "recorded_home", "recorded_away",
                    ((rh == col("recorded_home")) & (ra == col("recorded_away"))).alias("reconciled"))
