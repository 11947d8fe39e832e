"""Serving extracts over the marts: leaderboards, team-vs-average, position groups, state summaries.

Top-k lists use ``orderBy(...).limit(k)`` (TakeOrderedAndProject: every task keeps its own top k
and only k rows per task reach the final merge) with a unique tie-breaker, NULLs last. Averages
"over all rows" are uncorrelated scalar subqueries (``DataFrame.scalar()``), evaluated once with
partial aggregation -- no cross join and no single-partition window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions.exprs import exact_mean, round_half_away as rnd

col = F.col


def top_k(df: DataFrame, order: list[Column], k: int, board: str, value: Column,
          label_cols: list[str]) -> DataFrame:
    """The first k rows by ``order`` as (board, rank, labels..., metric_value)."""
    top = df.orderBy(*order).limit(k)
    w = Window.orderBy(*order)  # numbers at most k rows, after the limit
    return top.select(F.lit(board).alias("board"), F.row_number().over(w).cast("long").alias("rank"),
                      *label_cols, value.cast("double").alias("metric_value"))


def team_leaderboards(m1: DataFrame, m2: DataFrame, m3: DataFrame, m4: DataFrame) -> DataFrame:
    """The validation / overview lists of the team marts, with their volume gates."""
    lab = ["team_comp_key", "team_name", "competition_name"]
    tie = col("team_comp_key").asc()
    d = lambda c: col(c).desc_nulls_last()
    a = lambda c: col(c).asc_nulls_last()
    boards = [
        top_k(m1, [d("xg_per_match"), tie], 10, "m1_xg_per_match", col("xg_per_match"), lab),
        top_k(m2, [d("progressive_passes_per_match"), tie], 10, "m2_progressive_passes",
              col("progressive_passes_per_match"), lab),
        top_k(m2.where(col("possessions_reaching_f3") >= 20), [d("final_third_to_shot_rate"), tie], 10,
              "m2_f3_to_shot_rate", col("final_third_to_shot_rate"), lab),
        top_k(m2.where(col("progressive_passes") >= 20), [a("progressive_pass_completion_rate"), tie], 5,
              "m2_worst_prog_completion", col("progressive_pass_completion_rate"), lab),
        top_k(m3.where(col("matches_played") >= 3), [a("ppda"), tie], 10, "m3_lowest_ppda", col("ppda"), lab),
        top_k(m3.where(col("matches_played") >= 3), [d("ppda"), tie], 10, "m3_highest_ppda", col("ppda"), lab),
        top_k(m3, [d("high_press_share"), tie], 10, "m3_high_press_share", col("high_press_share"), lab),
        top_k(m4.where(col("matches_played") >= 3), [d("sp_xg_per_match"), tie], 10, "m4_sp_xg_per_match",
              col("sp_xg_per_match"), lab),
        top_k(m4.where((col("matches_played") >= 3) & (col("total_xg") >= 3.0)),
              [d("sp_xg_share_of_total"), tie], 10, "m4_sp_dependency", col("sp_xg_share_of_total"), lab),
        top_k(m4.where(col("sp_shots_total") >= 8), [d("sp_conversion_rate"), tie], 10,
              "m4_sp_conversion", col("sp_conversion_rate"), lab),
    ]
    return reduce(DataFrame.unionByName, boards)


def player_leaderboards(m5: DataFrame) -> DataFrame:
    lab = ["team_comp_key", "player_id", "player_name", "primary_position"]
    ties = [col("player_id").asc(), col("team_comp_key").asc()]
    not_gk = ~col("primary_position").like("Goalkeeper%")
    xgxa = col("np_xg_per_90") + col("xa_per_90")
    carrier = col("prog_carries_per_90") + col("successful_dribbles_per_90")
    return reduce(DataFrame.unionByName, [
        top_k(m5, [xgxa.desc_nulls_last(), *ties], 10, "m5_np_xg_plus_xa_per_90", xgxa, lab),
        top_k(m5.where(not_gk), [col("pressures_per_90").desc_nulls_last(), *ties], 10,
              "m5_pressures_per_90", col("pressures_per_90"), lab),
        top_k(m5.where(not_gk), [carrier.desc_nulls_last(), *ties], 10, "m5_ball_carrier", carrier, lab),
    ])


def minutes_distribution(m5: DataFrame) -> DataFrame:
    return m5.agg(F.min("minutes_played").alias("min_min"), F.max("minutes_played").alias("max_min"),
                  exact_mean("minutes_played").alias("avg_min"),
                  F.count(F.lit(1)).alias("player_seasons"))


# The six team-profile metrics compared with the all-rows average.
PROFILE_METRICS = [
    ("m1", "xg_per_match"), ("m2", "progressive_passes_per_match"),
    ("m2", "final_third_entries_per_match"), ("m3", "ppda"), ("m3", "counterpress_share"),
    ("m1", "set_piece_xg_share"),
]


def team_vs_average(marts: dict[str, DataFrame], team: str | None = None,
                    competition: str | None = None) -> DataFrame:
    """Per team row and metric: the team's value next to the average over ALL rows of its mart.

    Optional slicers (team, competition) filter the team rows only, never the average.
    """
    parts = []
    for mart, metric in PROFILE_METRICS:
        m = marts[mart]
        # displayed average of the displayed (rounded) values, to 4 places
        avg_all = rnd(m.select(exact_mean(metric)).scalar(), 4)
        rows = m
        if team is not None:
            rows = rows.where(col("team_name") == team)
        if competition is not None:
            rows = rows.where(col("competition_folder_name") == competition)
        parts.append(rows.select("team_comp_key", "team_name", "competition_name",
                                 F.lit(metric).alias("metric"),
                                 col(metric).cast("double").alias("team_value"),
                                 avg_all.alias("all_rows_average")))
    return reduce(DataFrame.unionByName, parts)


def position_group(pos: Column) -> Column:
    """Fold granular positions into 8 buckets; ordered rules, first match wins (our own rules:
    Goalkeeper; Center Back; other Back -> Fullback; Defensive Mid; Attacking Mid; wide
    Left/Right Midfield -> Winger; other Midfield -> Central Mid; Wing -> Winger; else Forward)."""
    return (F.when(pos == "Goalkeeper", "Goalkeeper")
            .when(pos.contains("Center Back"), "Center Back")
            .when(pos.contains("Back"), "Fullback")
            .when(pos.contains("Defensive Midfield"), "Defensive Mid")
            .when(pos.contains("Attacking Midfield"), "Attacking Mid")
            .when(pos.isin("Left Midfield", "Right Midfield"), "Winger")
            .when(pos.contains("Midfield"), "Central Mid")
            .when(pos.contains("Wing"), "Winger")
            .when(pos.isNotNull(), "Forward"))


def position_groups(m5: DataFrame) -> DataFrame:
    return (m5.select(position_group(col("primary_position")).alias("position_group"))
            .groupBy("position_group").agg(F.count(F.lit(1)).alias("n_players")))


def state_summary(m6: DataFrame) -> DataFrame:
    """Per game state: team-match count, mean minutes, mean xG/min and mean field position."""
    return (m6.groupBy("game_state")
            .agg(F.count(F.lit(1)).alias("n_team_matches"),
                 rnd(exact_mean("minutes_in_state"), 1).alias("avg_minutes"),
                 rnd(exact_mean("xg_per_minute"), 4).alias("avg_xg_per_min"),
                 rnd(exact_mean("avg_field_position_x"), 1).alias("mean_x")))


def state_contrast(m6: DataFrame, k: int = 10) -> DataFrame:
    """Teams whose xG/min changes most between Losing and Winning (both states present)."""
    p = (m6.where(col("game_state").isin("Winning", "Losing"))
         .groupBy("team_name", "competition_name")
         .pivot("game_state", ["Losing", "Winning"]).agg(F.max("xg_per_minute")))
    p = (p.withColumnRenamed("Losing", "xg_per_min_losing").withColumnRenamed("Winning", "xg_per_min_winning")
         .where(col("xg_per_min_losing").isNotNull() & col("xg_per_min_winning").isNotNull())
         .withColumn("delta", rnd(col("xg_per_min_losing") - col("xg_per_min_winning"), 4)))
    return p.orderBy(col("delta").desc_nulls_last(), col("team_name").asc(),
                     col("competition_name").asc_nulls_last()).limit(k)


def dim_team_competition(m1: DataFrame) -> DataFrame:
    return m1.select(
        F.concat(col("team_name"), F.lit("|"), col("competition_folder_name"), F.lit("|"),
                 col("season_year").cast("string")).alias("team_comp_key"),
        "team_name", "competition_name", "competition_folder_name", "season_year").distinct()


def dashboard_lists(m2: DataFrame, m3: DataFrame, m4: DataFrame, m5: DataFrame) -> DataFrame:
    """Overview and player page lists: top 12 set-piece xG share, top 12 final-third entries per
    match, top 15 lowest PPDA, top 30 players by npxG + xA per 90."""
    lab = ["team_comp_key", "team_name", "competition_name"]
    tie = col("team_comp_key").asc()
    xgxa = col("np_xg_per_90") + col("xa_per_90")
    return reduce(DataFrame.unionByName, [
        top_k(m4, [col("sp_xg_share_of_total").desc_nulls_last(), tie], 12, "overview_set_piece_share",
              col("sp_xg_share_of_total"), lab),
        top_k(m2, [col("final_third_entries_per_match").desc_nulls_last(), tie], 12, "overview_f3_entries",
              col("final_third_entries_per_match"), lab),
        top_k(m3, [col("ppda").asc_nulls_last(), tie], 15, "overview_lowest_ppda", col("ppda"), lab),
        top_k(m5.withColumn("team_name", col("player_name")),
              [xgxa.desc_nulls_last(), col("player_id").asc(), tie], 30, "players_top30", xgxa, lab),
    ])


def xg_vs_goals(m1: DataFrame) -> DataFrame:
    """The overview scatter: every team-tournament's xG, goals and their difference."""
    return m1.select("team_comp_key", "team_name", "competition_name", "xg_total", "goals",
                     "xg_overperformance")


def _exact_sum(x, digits: int) -> Column:
    """Sum of values with at most ``digits`` decimals, independent of summation order."""
    scale = float(10 ** digits)
    return F.sum(F.round(col(x) * F.lit(scale), 0)) / F.lit(scale)


def score_chasers(m6: DataFrame, k: int = 10) -> DataFrame:
    """Teams with the most xG per minute while losing (summed over their matches)."""
    losing = (m6.where(col("game_state") == "Losing")
              .groupBy("team_name", "competition_name")
              .agg(F.sum("xg_raw").alias("xg_losing"), _exact_sum("minutes_in_state", 1).alias("minutes_losing")))
    out = losing.withColumn("xg_per_min_losing", rnd(col("xg_losing") / F.nullif(col("minutes_losing"), F.lit(0.0)), 4))
    return out.orderBy(col("xg_per_min_losing").desc_nulls_last(), col("team_name"),
                       col("competition_name").asc_nulls_last()).limit(k)


def deep_run_lines(m6: DataFrame, outcomes: DataFrame, n_teams: int = 6) -> DataFrame:
    """Mean field position per game state for the ``n_teams`` deepest tournament runs."""
    deepest = (outcomes.orderBy(col("max_stage_rank").desc(), col("team_comp_key")).limit(n_teams)
               .select("team_comp_key"))
    rows = m6.join(deepest, "team_comp_key", "left_semi")
    return (rows.groupBy("team_comp_key", "team_name", "game_state")
            .agg(rnd(exact_mean("avg_field_position_x"), 1).alias("mean_x"),
                 F.count(F.lit(1)).alias("n_matches")))


def findings(m1: DataFrame, m3: DataFrame, m4: DataFrame, outcomes: DataFrame, k: int = 5) -> DataFrame:
    """The findings page as three fixed extracts (rows tagged by ``finding``):
    trophies vs xG (all finalists' xG against goals, ranked in their tournament), set-piece waste (most set-piece xG per match
    with the lowest conversion, at least 8 set-piece shots) and low block (highest PPDA among
    teams with at least 3 matches)."""
    lab = ["team_comp_key", "team_name", "competition_name"]
    tie = col("team_comp_key").asc()
    finalists = m1.join(outcomes.where(col("outcome_class") == "Finalist").select("team_comp_key"),
                        "team_comp_key", "left_semi")
    return reduce(DataFrame.unionByName, [
        finalists.select(
            F.lit("trophies_vs_xg").alias("board"),
            F.row_number().over(Window.partitionBy("competition_folder_name", "season_year").orderBy(
                col("xg_overperformance").asc_nulls_last(), tie)).cast("long").alias("rank"),
            *lab, col("xg_overperformance").cast("double").alias("metric_value")),
        top_k(m4.where(col("sp_shots_total") >= 8),
              [col("sp_conversion_rate").asc_nulls_last(), col("sp_xg_per_match").desc_nulls_last(), tie],
              k, "set_piece_waste", col("sp_conversion_rate"), lab),
        top_k(m3.where(col("matches_played") >= 3), [col("ppda").desc_nulls_last(), tie], k, "low_block",
              col("ppda"), lab),
    ])
