"""Registered queries for the team-grain marts and their building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitchline.functions.exprs import count_when, ratio, round_half_away as rnd
from pitchline.plans import team_marts as tm
from pitchline.plans.catalog import Tables, query

col = F.col


@query("mart_attack_quality")
def q_mart_attack_quality(spark, sf):
    t = Tables(spark, sf)
    return tm.mart_attack_quality(t.ev, t.comps)


@query("mart_set_piece")
def q_mart_set_piece(spark, sf):
    t = Tables(spark, sf)
    return tm.mart_set_piece(t.ev, t.comps)


@query("mart_ball_progression")
def q_mart_ball_progression(spark, sf):
    t = Tables(spark, sf)
    return tm.mart_ball_progression(t.ev, t.comps)


@query("progression_actions")
def q_progression_actions(spark, sf):
    return tm.progression_flags(Tables(spark, sf).ev)


@query("possession_flags")
def q_possession_flags(spark, sf):
    return tm.possession_flags(Tables(spark, sf).ev)


@query("mart_defensive_pressure")
def q_mart_defensive_pressure(spark, sf):
    t = Tables(spark, sf)
    return tm.mart_defensive_pressure(t.ev, t.matches, t.comps)


@query("match_sides")
def q_match_sides(spark, sf):
    return tm.match_sides(Tables(spark, sf).matches)


@query("opponent_zone_passes")
def q_opponent_zone_passes(spark, sf):
    t = Tables(spark, sf)
    pred = ((col("event_type") == "Pass") & col("start_x").isNotNull()
            & (col("start_x") <= tm.PPDA_OPP_MAX_X))
    return tm.opponent_ratio_counts(t.ev, t.matches, pred, "opp_passes_in_zone_raw")


@query("matches_played")
def q_matches_played(spark, sf):
    """Matches per team counted from events (not from the schedule)."""
    return (Tables(spark, sf).ev.groupBy(*tm.TEAM_KEYS)
            .agg(F.count_distinct("match_id").alias("matches_played")))


@query("np_shots_filter")
def q_np_shots_filter(spark, sf):
    """Non-penalty shots; a NULL shot_type is dropped by ``!=`` exactly as in SQL WHERE."""
    return (Tables(spark, sf).ev.where(tm.np_shot())
            .select("event_id", "match_id", "team", "xg", "shot_type", "shot_outcome", "play_pattern"))


@query("conditional_aggs")
def q_conditional_aggs(spark, sf):
    """Per (team, competition, season): the conditional-sum family over all event kinds."""
    et = col("event_type")
    return (Tables(spark, sf).ev.groupBy(*tm.TEAM_KEYS)
            .agg(F.count(F.lit(1)).alias("n_events"),
                 count_when(et == "Pass").alias("passes"),
                 count_when((et == "Pass") & col("pass_outcome").isNull()).alias("passes_completed"),
                 count_when(et == "Pressure").alias("pressures"),
                 count_when((et == "Pressure") & col("counterpress")).alias("counterpresses"),
                 count_when(et == "Shot").alias("shots"),
                 count_when((et == "Shot") & (col("shot_type") != "Penalty")).alias("np_shots"),
                 F.sum(F.when(et == "Shot", col("xg")).otherwise(F.lit(0.0))).alias("xg_all"),
                 count_when((et == "Dribble") & (col("dribble_outcome") == "Complete")).alias("dribbles_won"),
                 count_when((et == "Duel") & (col("duel_type") == "Tackle")).alias("tackles")))


@query("ratio_metrics")
def q_ratio_metrics(spark, sf):
    """Safe division, double promotion and engine-stable rounding at several precisions."""
    base = q_conditional_aggs(spark, sf)
    return base.select(
        *tm.TEAM_KEYS,
        rnd(ratio("passes_completed", "passes"), 3).alias("pass_completion"),
        rnd(ratio("counterpresses", "pressures"), 4).alias("counterpress_share"),
        rnd(ratio("xg_all", "shots"), 2).alias("xg_per_shot"),
        rnd(ratio("dribbles_won", col("tackles") - col("tackles")), 2).alias("always_null"),
        rnd(ratio("n_events", F.lit(7)), 1).alias("events_per_7"),
        rnd(ratio("np_shots", "shots"), 0).alias("np_share_r0"))
