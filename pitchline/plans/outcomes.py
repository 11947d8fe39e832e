"""Tournament outcome labels (deepest stage reached) and the ML feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions.exprs import team_key

col = F.col

# Stage name -> depth rank; anything else ranks 0 (no class).
STAGE_RANKS = {"Group Stage": 1, "Round of 16": 2, "Quarter-finals": 3, "Semi-finals": 4,
               "3rd Place Final": 5, "Final": 6}

# The 17 model features, in the original order.
FEATURES = [
    "shots_per_match", "xg_per_match", "xg_per_shot", "open_play_xg_share", "set_piece_xg_share",
    "progressive_passes_per_match", "progressive_carries_per_match", "final_third_entries_per_match",
    "progressive_pass_completion_rate", "final_third_to_shot_rate",
    "pressures_per_match", "high_press_share", "counterpress_share", "ppda", "high_press_regain_rate",
    "sp_xg_per_match", "sp_conversion_rate",
]


def stage_rank_expr(stage):
    out = None
    for name, r in STAGE_RANKS.items():
        out = F.when(stage == name, F.lit(r)) if out is None else out.when(stage == name, F.lit(r))
    return out.otherwise(F.lit(0))


def team_outcomes(matches: DataFrame) -> DataFrame:
    """Deepest stage per (team, competition, season) from both sides of every match (one scan:
    explode of home/away), and its outcome class: 1 group exit, 2-5 knockout, 6 finalist."""
    sides = matches.select("competition_folder_name", "season_year",
                           stage_rank_expr(col("competition_stage_name")).alias("stage_rank"),
                           F.explode(F.array("home_team_name", "away_team_name")).alias("team_name"))
    deepest = (sides.groupBy("team_name", "competition_folder_name", "season_year")
               .agg(F.max("stage_rank").alias("max_stage_rank")))
    r = col("max_stage_rank")
    return deepest.select(
        team_key(col("team_name"), col("competition_folder_name"), col("season_year")).alias("team_comp_key"),
        "team_name", "competition_folder_name", "season_year", "max_stage_rank",
        F.when(r == 1, "Group-stage exit").when(r.between(2, 5), "Knockout pre-final")
        .when(r == 6, "Finalist").alias("outcome_class"))


def ml_features(outcomes: DataFrame, m1: DataFrame, m2: DataFrame, m3: DataFrame,
                m4: DataFrame) -> DataFrame:
    """Labels left-joined to the four team marts on the composite key (a team missing from a
    mart keeps NULL features). All five inputs are at team grain."""
    a = m1.select("team_comp_key", "matches_played", "shots_per_match", "xg_per_match", "xg_per_shot",
                  "open_play_xg_share", "set_piece_xg_share")
    p = m2.select("team_comp_key", "progressive_passes_per_match", "progressive_carries_per_match",
                  "final_third_entries_per_match", "progressive_pass_completion_rate",
                  "final_third_to_shot_rate")
    d = m3.select("team_comp_key", "pressures_per_match", "high_press_share", "counterpress_share",
                  "ppda", "high_press_regain_rate")
    s = m4.select("team_comp_key", "sp_xg_per_match", "sp_conversion_rate")
    base = outcomes.select("team_comp_key", "team_name", "competition_folder_name", "season_year",
                           "outcome_class")
    return (base.join(a, "team_comp_key", "left").join(p, "team_comp_key", "left")
            .join(d, "team_comp_key", "left").join(s, "team_comp_key", "left"))
