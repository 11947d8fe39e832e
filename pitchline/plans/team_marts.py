"""Team-grain marts (team, competition, season): attack quality, set pieces, progression, pressing.

Each mart is ONE aggregation over the event table with conditional sums, instead of several
aggregates of the same table joined back together. Team-grain output is tiny, so partial
(map-side) aggregation shrinks every task's rows to a handful before the shuffle, whatever the
skew of the input. The competition dimension is joined last, to the aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions.exprs import (
    FINAL_THIRD_X, HALFWAY_X, OPEN_PLAY_PATTERNS, PPDA_OPP_MAX_X, PPDA_OWN_MIN_X,
    SET_PIECE_CHAIN_PATTERNS, SET_PIECE_PATTERNS, any_flag, count_when, is_progressive,
    is_zone_entry, ratio, round_half_away as rnd, team_key,
)

TEAM_KEYS = ["team", "competition", "season"]
col = F.col


def np_shot() -> Column:
    """Non-penalty shot. A NULL shot_type makes ``!=`` NULL, so the row is not counted (SQL semantics)."""
    return (col("event_type") == "Shot") & (col("shot_type") != "Penalty")


def with_dim(agg: DataFrame, comps: DataFrame) -> DataFrame:
    """Inner join aggregated team rows to the competition dimension and add the identity columns.
    Rows without a team have no identity and drop out, as in a join on the team.

    No broadcast hint: both sides are aggregates and AQE measures them at runtime, broadcasting
    only below ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
    """
    j = agg.where(col("team").isNotNull()).join(comps, (agg.competition == comps.competition_folder_name)
                 & (agg.season == comps.season_year), "inner")
    return j.select(
        team_key(col("team"), col("competition_folder_name"), col("season_year")).alias("team_comp_key"),
        col("team").alias("team_name"), "competition_name", "competition_folder_name", "season_year",
        *[c for c in agg.columns if c not in TEAM_KEYS])


# ---------------------------------------------------------------- M1 attack quality
def attack_counts(ev: DataFrame) -> DataFrame:
    """Per team: matches with any event, non-penalty shots, xG, goals, xG by play-pattern bucket."""
    s = np_shot()
    in_open = col("play_pattern").isin(*OPEN_PLAY_PATTERNS)
    in_sp = col("play_pattern").isin(*SET_PIECE_PATTERNS)
    return (ev.groupBy(*TEAM_KEYS)
            .agg(F.count_distinct("match_id").alias("matches_played"),
                 count_when(s).alias("shots_total"),
                 F.sum(F.when(s, col("xg"))).alias("xg_total"),
                 count_when(s & (col("shot_outcome") == "Goal")).alias("goals"),
                 F.sum(F.when(s, F.when(in_open, col("xg")).otherwise(F.lit(0.0)))).alias("xg_open_play"),
                 F.sum(F.when(s, F.when(in_sp, col("xg")).otherwise(F.lit(0.0)))).alias("xg_set_piece"))
            # teams without a non-penalty shot drop out, as in the inner join of the SQL model
            .where(col("shots_total") > 0))


def mart_attack_quality(ev: DataFrame, comps: DataFrame) -> DataFrame:
    """M1, grain (team, competition, season): non-penalty shot volume, xG, goals and the share
    of xG from open play and from set pieces (buckets are not exhaustive)."""
    a = attack_counts(ev)
    m = col("matches_played")
    out = a.select(
        *TEAM_KEYS, "matches_played", "shots_total",
        rnd(ratio("shots_total", m), 2).alias("shots_per_match"),
        rnd("xg_total", 2).alias("xg_total_r"),
        rnd(ratio("xg_total", m), 2).alias("xg_per_match"),
        rnd(ratio("xg_total", "shots_total"), 3).alias("xg_per_shot"),
        "goals",
        rnd(col("goals") - col("xg_total"), 2).alias("xg_overperformance"),
        rnd(ratio("xg_open_play", "xg_total"), 3).alias("open_play_xg_share"),
        rnd(ratio("xg_set_piece", "xg_total"), 3).alias("set_piece_xg_share"),
    ).withColumnRenamed("xg_total_r", "xg_total")
    return with_dim(out, comps)


# ---------------------------------------------------------------- M4 set pieces
def mart_set_piece(ev: DataFrame, comps: DataFrame,
                   patterns=SET_PIECE_CHAIN_PATTERNS) -> DataFrame:
    """Full-chain set-piece effectiveness: every event inherits its possession's play pattern,
    so a pattern filter captures second balls and recycled deliveries without chain tracking."""
    s = np_shot()
    sp = s & col("play_pattern").isin(*patterns)
    a = (ev.groupBy(*TEAM_KEYS)
         .agg(F.count_distinct("match_id").alias("matches_played"),
              count_when(sp).alias("sp_shots_total"),
              F.sum(F.when(sp, col("xg"))).alias("sp_xg"),
              count_when(sp & (col("shot_outcome") == "Goal")).alias("sp_goals"),
              F.sum(F.when(s, col("xg"))).alias("total_xg_raw"))
         .where(col("sp_shots_total") > 0))
    m = col("matches_played")
    out = a.select(
        *TEAM_KEYS, "matches_played",
        rnd(ratio("sp_xg", m), 2).alias("sp_xg_per_match"),
        rnd(ratio("sp_goals", m), 2).alias("sp_goals_per_match"),
        rnd(ratio("sp_shots_total", m), 2).alias("sp_shots_per_match"),
        rnd(ratio("sp_xg", "sp_shots_total"), 3).alias("sp_xg_per_shot"),
        rnd(ratio("sp_goals", "sp_shots_total"), 3).alias("sp_conversion_rate"),
        rnd(ratio("sp_xg", "total_xg_raw"), 3).alias("sp_xg_share_of_total"),
        "sp_shots_total",
        rnd("sp_xg", 2).alias("sp_xg_total"),
        "sp_goals",
        rnd("total_xg_raw", 2).alias("total_xg"),
    )
    return with_dim(out, comps)


# ---------------------------------------------------------------- M2 ball progression
def end_x_for() -> Column:
    """Pass end for passes, carry end for carries (the FB view carries one ``end_x`` for both)."""
    return F.when(col("event_type").isin("Pass", "Carry"), col("end_x"))


def progression_flags(ev: DataFrame) -> DataFrame:
    """Per located pass/carry: progressive, final-third entry, completed (NULL for carries)."""
    ex = end_x_for()
    return (ev.where(col("event_type").isin("Pass", "Carry") & col("start_x").isNotNull())
            .select(*TEAM_KEYS, "match_id", "event_id", "event_type", "start_x",
                    ex.alias("end_x"),
                    F.when(is_progressive(col("start_x"), ex), 1).otherwise(0).alias("is_progressive"),
                    F.when(is_zone_entry(col("start_x"), ex), 1).otherwise(0)
                    .alias("is_final_third_entry"),
                    F.when(col("event_type") == "Pass",
                           F.when(col("pass_outcome").isNull(), 1).otherwise(0))
                    .alias("is_completed_pass")))


def possession_flags(ev: DataFrame) -> DataFrame:
    """Per (acting team, match, possession): reached the final third / contained a shot.

    Grouped by the *acting* team, so an out-of-possession team's events in that possession form
    their own group. Two-level aggregate: this grouping is then summed per team.
    """
    return (ev.groupBy(*TEAM_KEYS, "match_id", "possession_sequence")
            .agg(any_flag(col("start_x") >= FINAL_THIRD_X).alias("reached_final_third"),
                 any_flag(col("event_type") == "Shot").alias("ended_with_shot")))


def mart_ball_progression(ev: DataFrame, comps: DataFrame) -> DataFrame:
    """M2 from ONE scan of the events: a possession-grain aggregate carries both the possession
    flags and the action counts, and is rolled up to team grain (two-level aggregate)."""
    located = (col("event_type").isin("Pass", "Carry") & col("start_x").isNotNull())
    ex = end_x_for()
    prog = located & is_progressive(col("start_x"), ex)
    is_pass = col("event_type") == "Pass"
    poss = (ev.groupBy(*TEAM_KEYS, "match_id", "possession_sequence")
            .agg(any_flag(col("start_x") >= FINAL_THIRD_X).alias("reached_final_third"),
                 any_flag(col("event_type") == "Shot").alias("ended_with_shot"),
                 count_when(located).alias("n_actions"),
                 count_when(prog & is_pass).alias("progressive_passes"),
                 count_when(prog & (col("event_type") == "Carry")).alias("progressive_carries"),
                 count_when(located & is_zone_entry(col("start_x"), ex)).alias("final_third_entries"),
                 count_when(prog & is_pass & col("pass_outcome").isNull()).alias("prog_completed")))
    a = (poss.groupBy(*TEAM_KEYS)
         # matches counted only over located passes and carries
         .agg(F.count_distinct(F.when(col("n_actions") > 0, col("match_id"))).alias("matches_played"),
              F.sum("n_actions").alias("n_actions"),
              F.sum("progressive_passes").cast("long").alias("progressive_passes"),
              F.sum("progressive_carries").cast("long").alias("progressive_carries"),
              F.sum("final_third_entries").cast("long").alias("final_third_entries"),
              F.sum("prog_completed").cast("long").alias("prog_completed"),
              F.sum("reached_final_third").cast("long").alias("possessions_reaching_f3"),
              count_when((col("reached_final_third") == 1) & (col("ended_with_shot") == 1))
              .alias("possessions_f3_with_shot"))
         # teams without a located pass or carry drop out (inner join in the SQL original)
         .where(col("n_actions") > 0))
    m = col("matches_played")
    out = a.select(
        *TEAM_KEYS, "matches_played",
        rnd(ratio("progressive_passes", m), 2).alias("progressive_passes_per_match"),
        rnd(ratio("progressive_carries", m), 2).alias("progressive_carries_per_match"),
        rnd(ratio("final_third_entries", m), 2).alias("final_third_entries_per_match"),
        rnd(ratio("prog_completed", "progressive_passes"), 3).alias("progressive_pass_completion_rate"),
        rnd(ratio("possessions_f3_with_shot", "possessions_reaching_f3"), 3)
        .alias("final_third_to_shot_rate"),
        "progressive_passes", "progressive_carries", "final_third_entries",
        "possessions_reaching_f3", "possessions_f3_with_shot",
    )
    return with_dim(out, comps)


# ---------------------------------------------------------------- M3 defensive pressure
def match_sides(matches: DataFrame) -> DataFrame:
    """(match, team, opponent, is_home) for both teams of every match, from ONE scan of matches:
    ``explode(array(home_struct, away_struct))`` instead of a UNION ALL that reads it twice."""
    home = F.struct(col("home_team_name").alias("team"), col("away_team_name").alias("opponent"),
                    F.lit(True).alias("is_home"))
    away = F.struct(col("away_team_name").alias("team"), col("home_team_name").alias("opponent"),
                    F.lit(False).alias("is_home"))
    return (matches.select("match_id", col("competition_folder_name").alias("competition"),
                           col("season_year").alias("season"),
                           F.explode(F.array(home, away)).alias("s"))
            .select("match_id", "competition", "season", "s.team", "s.opponent", "s.is_home"))


def opponent_ratio_counts(ev: DataFrame, matches: DataFrame, event_pred: Column,
                          name: str) -> DataFrame:
    """For each team, count events satisfying ``event_pred`` that its *opponents* performed.

    Aggregate first to (match, team) -- at most two rows per match -- then join the pairs on
    (match, opponent). Only aggregated rows cross the join, never raw events.
    """
    per_match = (ev.where(event_pred)
                 .groupBy("match_id", "team", "competition", "season")
                 .agg(F.count(F.lit(1)).alias("_n")))
    pairs = match_sides(matches)
    j = pairs.join(per_match.withColumnRenamed("team", "opponent"),
                   ["match_id", "opponent", "competition", "season"], "inner")
    return j.groupBy(*TEAM_KEYS).agg(F.sum("_n").cast("long").alias(name))


def mart_defensive_pressure(ev: DataFrame, matches: DataFrame, comps: DataFrame) -> DataFrame:
    """M3 from ONE scan of the events.

    Located events are aggregated per (team, match): own pressing counts, and the team's passes in
    the opponent's PPDA zone. That table has about two rows per match. The opponent's zone passes
    come from joining every match side to its opponent's row, so they count also where the team
    itself has no located event in the match. No raw events cross a join.
    """
    located = col("start_x").isNotNull()
    et = col("event_type")
    press = et == "Pressure"
    cp = press & col("counterpress")
    per_match = (ev.where(located).groupBy(*TEAM_KEYS, "match_id")
                 .agg(count_when(press).alias("pressures_total"),
                      count_when(press & (col("start_x") >= HALFWAY_X)).alias("pressures_high"),
                      count_when(cp).alias("counterpresses_total"),
                      count_when(cp & (col("start_x") >= HALFWAY_X)).alias("counterpresses_high"),
                      count_when(et == "Duel").alias("duels_total"),
                      count_when(et == "Foul Committed").alias("fouls_total"),
                      count_when(et == "Ball Recovery").alias("recoveries_total"),
                      count_when((press | ((et == "Duel") & (col("duel_type") == "Tackle"))
                                  | (et == "Foul Committed")) & (col("start_x") >= PPDA_OWN_MIN_X))
                      .alias("ppda_denom_raw"),
                      count_when((et == "Pass") & (col("start_x") <= PPDA_OPP_MAX_X)).alias("zone_passes")))
    counts = ["pressures_total", "pressures_high", "counterpresses_total", "counterpresses_high",
              "duels_total", "fouls_total", "recoveries_total", "ppda_denom_raw"]
    own = per_match.groupBy(*TEAM_KEYS).agg(
        F.count(F.lit(1)).alias("matches_played"), *[F.sum(c).cast("long").alias(c) for c in counts])
    against = per_match.where(col("zone_passes") > 0).select(
        "match_id", "competition", "season", col("team").alias("opponent"), "zone_passes")
    faced = (match_sides(matches).join(against, ["match_id", "opponent", "competition", "season"])
             .groupBy(*TEAM_KEYS).agg(F.sum("zone_passes").cast("long").alias("opp_passes_in_zone_raw")))
    a = own.join(faced, TEAM_KEYS)
    m = col("matches_played")
    out = a.select(
        *TEAM_KEYS, "matches_played",
        rnd(ratio("pressures_total", m), 2).alias("pressures_per_match"),
        rnd(ratio("pressures_high", "pressures_total"), 3).alias("high_press_share"),
        rnd(ratio("counterpresses_total", "pressures_total"), 3).alias("counterpress_share"),
        rnd(ratio("opp_passes_in_zone_raw", "ppda_denom_raw"), 2).alias("ppda"),
        rnd(ratio(col("pressures_total") + col("duels_total") + col("fouls_total")
                  + col("recoveries_total"), m), 2).alias("defensive_actions_per_match"),
        rnd(ratio("counterpresses_high", "pressures_high"), 3).alias("high_press_regain_rate"),
        "pressures_total", "pressures_high", "counterpresses_total", "counterpresses_high",
        "opp_passes_in_zone_raw", "ppda_denom_raw",
    )
    return with_dim(out, comps)
