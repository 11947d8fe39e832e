"""Oracle SQL for checks, serving extracts, exports, outcome labels and ML features."""

from pitchline.oracle import gamestate_sql as g
from pitchline.oracle import players_sql as p
from pitchline.oracle import team_sql as t
from pitchline.oracle.base import with_fb

MARTS = {"m1": t.MART_ATTACK_QUALITY, "m2": t.MART_BALL_PROGRESSION, "m3": t.MART_DEFENSIVE_PRESSURE,
         "m4": t.MART_SET_PIECE, "m5": p.MART_PLAYER_IMPACT, "m6": g.MART_GAMESTATE}


def mart_cte(name: str) -> str:
    return f"{name} as ({MARTS[name]})"


def q(body: str, *marts: str, extra: tuple = ()) -> str:
    return with_fb(body, *[mart_cte(m) for m in marts], *extra)


def _nn(table: str, source: str, cols: list[str]) -> str:
    return "\nunion all\n".join(
        f"select '{table}' as table_name, 'not_null' as check_name, '{c}' as column_name, "
        f"cast(count(*) filter (where {c} is null) as bigint) as failures from {source}" for c in cols)


CHECK_NOT_NULL = q("\nunion all\n".join([
    _nn("stg_events", "fb", ["event_id", "match_id", "competition", "event_type"]),
    _nn("stg_matches", "fb_matches", ["match_id", "home_team_name", "away_team_name", "match_date"]),
    _nn("stg_competitions", "fb_competitions", ["competition_name", "competition_folder_name"]),
    _nn("stg_lineups", "fb_lineups", ["match_id", "player_id", "team_name"]),
    _nn("mart_team_attack_quality", "m1", ["team_name", "competition_name", "matches_played", "xg_per_match"]),
    _nn("mart_team_ball_progression", "m2", ["team_name", "progressive_passes_per_match"]),
    _nn("mart_team_defensive_pressure", "m3", ["team_name", "ppda"]),
    _nn("mart_team_set_piece_effectiveness", "m4", ["team_name", "sp_xg_per_match"]),
    _nn("mart_player_impact", "m5", ["player_id", "player_name", "minutes_played", "np_xg_per_90"]),
    _nn("mart_team_gamestate_behavior", "m6", ["team_name", "game_state", "minutes_in_state"]),
]), "m1", "m2", "m3", "m4", "m5", "m6")


def _uq(table: str, source: str, c: str) -> str:
    return (f"select '{table}' as table_name, 'unique' as check_name, '{c}' as column_name, "
            f"cast(count(*) as bigint) as failures from (select {c} from {source} where {c} is not null "
            f"group by {c} having count(*) > 1)")


CHECK_UNIQUE = q("\nunion all\n".join([
    _uq("stg_events", "fb", "event_id"), _uq("stg_matches", "fb_matches", "match_id"),
    _uq("stg_competitions", "fb_competitions", "competition_folder_name")]))

CHECK_ACCEPTED = q("""
select 'stg_events' as table_name, 'accepted_values' as check_name, 'competition' as column_name,
  cast(count(*) filter (where competition not in ('comp_0', 'comp_1', 'comp_2')) as bigint) as failures from fb
union all
select 'mart_team_gamestate_behavior', 'accepted_values', 'game_state',
  cast(count(*) filter (where game_state not in ('Winning', 'Drawing', 'Losing')) as bigint) from m6""", "m6")

OUTCOMES_CTE = """team_outcomes as (
  select team_name || '|' || competition_folder_name || '|' || cast(season_year as varchar) as team_comp_key,
    team_name, competition_folder_name, season_year, max_stage_rank,
    case when max_stage_rank = 6 then 'Finalist'
         when max_stage_rank >= 2 then 'Knockout pre-final'
         when max_stage_rank = 1 then 'Group-stage exit' end as outcome_class
  from (select team_name, competition_folder_name, season_year, max(stage_rank) as max_stage_rank
        from (select unnest([home_team_name, away_team_name]) as team_name, competition_folder_name,
                     season_year,
                     coalesce(list_position(['Group Stage', 'Round of 16', 'Quarter-finals', 'Semi-finals',
                                             '3rd Place Final', 'Final'], competition_stage_name), 0) as stage_rank
              from fb_matches)
        group by all))"""

FEATURES_CTE = """ml_dataset as (
  select o.team_comp_key, o.team_name, o.competition_folder_name, o.season_year, o.outcome_class,
    f1.* exclude (team_comp_key), f2.* exclude (team_comp_key), f3.* exclude (team_comp_key),
    f4.* exclude (team_comp_key)
  from team_outcomes o
  left join (select team_comp_key, matches_played, shots_per_match, xg_per_match, xg_per_shot,
                    open_play_xg_share, set_piece_xg_share from m1) f1 using (team_comp_key)
  left join (select team_comp_key, progressive_passes_per_match, progressive_carries_per_match,
                    final_third_entries_per_match, progressive_pass_completion_rate,
                    final_third_to_shot_rate from m2) f2 using (team_comp_key)
  left join (select team_comp_key, pressures_per_match, high_press_share, counterpress_share, ppda,
                    high_press_regain_rate from m3) f3 using (team_comp_key)
  left join (select team_comp_key, sp_xg_per_match, sp_conversion_rate from m4) f4 using (team_comp_key))"""

FEAT = ("m1", "m2", "m3", "m4")

CHECK_FEATURE_NULLS = q("""
select count(*) - count(matches_played) as missing_matches, count(*) - count(xg_per_match) as missing_xg,
  count(*) - count(ppda) as missing_ppda, count(*) - count(sp_xg_per_match) as missing_sp_xg
from ml_dataset""", *FEAT, extra=(OUTCOMES_CTE, FEATURES_CTE))

CHECK_SHARE_SUM = q("""
select team_comp_key, team_name, open_play_xg_share, set_piece_xg_share,
  (open_play_xg_share + set_piece_xg_share) as share_sum
from m1 order by share_sum asc nulls last, team_comp_key limit 5""", "m1")

DIM_TEAM_COMPETITION = q("""
select distinct team_name || '|' || competition_folder_name || '|' || cast(season_year as varchar) as team_comp_key,
  team_name, competition_name, competition_folder_name, season_year from m1""", "m1")


def _board(name: str, src: str, where: str, value: str, order: str, k: int, labels: str) -> str:
    return (f"select '{name}' as board, row_number() over (order by {order}) as rank, {labels}, "
            f"cast({value} as double) as metric_value from "
            f"(select * from {src} {('where ' + where) if where else ''} order by {order} limit {k})")


TL = "team_comp_key, team_name, competition_name"
LEADERBOARDS = q("\nunion all\n".join([
    _board("m1_xg_per_match", "m1", "", "xg_per_match", "xg_per_match desc nulls last, team_comp_key", 10, TL),
    _board("m2_progressive_passes", "m2", "", "progressive_passes_per_match",
           "progressive_passes_per_match desc nulls last, team_comp_key", 10, TL),
    _board("m2_f3_to_shot_rate", "m2", "possessions_reaching_f3 >= 20", "final_third_to_shot_rate",
           "final_third_to_shot_rate desc nulls last, team_comp_key", 10, TL),
    _board("m2_worst_prog_completion", "m2", "progressive_passes >= 20", "progressive_pass_completion_rate",
           "progressive_pass_completion_rate asc nulls last, team_comp_key", 5, TL),
    _board("m3_lowest_ppda", "m3", "matches_played >= 3", "ppda", "ppda asc nulls last, team_comp_key", 10, TL),
    _board("m3_highest_ppda", "m3", "matches_played >= 3", "ppda", "ppda desc nulls last, team_comp_key", 10, TL),
    _board("m3_high_press_share", "m3", "", "high_press_share",
           "high_press_share desc nulls last, team_comp_key", 10, TL),
    _board("m4_sp_xg_per_match", "m4", "matches_played >= 3", "sp_xg_per_match",
           "sp_xg_per_match desc nulls last, team_comp_key", 10, TL),
    _board("m4_sp_dependency", "m4", "matches_played >= 3 and total_xg >= 3.0", "sp_xg_share_of_total",
           "sp_xg_share_of_total desc nulls last, team_comp_key", 10, TL),
    _board("m4_sp_conversion", "m4", "sp_shots_total >= 8", "sp_conversion_rate",
           "sp_conversion_rate desc nulls last, team_comp_key", 10, TL),
]), "m1", "m2", "m3", "m4")

PL = "team_comp_key, player_id, player_name, primary_position"
TOPK_PLAYERS = q("\nunion all\n".join([
    _board("m5_np_xg_plus_xa_per_90", "m5", "", "np_xg_per_90 + xa_per_90",
           "np_xg_per_90 + xa_per_90 desc nulls last, player_id, team_comp_key", 10, PL),
    _board("m5_pressures_per_90", "m5", "primary_position not like 'Goalkeeper%'", "pressures_per_90",
           "pressures_per_90 desc nulls last, player_id, team_comp_key", 10, PL),
    _board("m5_ball_carrier", "m5", "primary_position not like 'Goalkeeper%'",
           "prog_carries_per_90 + successful_dribbles_per_90",
           "prog_carries_per_90 + successful_dribbles_per_90 desc nulls last, player_id, team_comp_key", 10, PL),
]), "m5")

MINMAXAVG_MINUTES = q("""
select min(minutes_played) as min_min, max(minutes_played) as max_min,
  sum(round(minutes_played * 1000000.0)) / count(minutes_played) / 1000000.0 as avg_min,
  count(*) as player_seasons from m5""", "m5")


def _tva(src: str, metric: str) -> str:
    return (f"select team_comp_key, team_name, competition_name, '{metric}' as metric, "
            f"cast({metric} as double) as team_value, "
            f"round((select sum(round({metric} * 1000000.0)) / count({metric}) / 1000000.0 from {src}), 4) "
            f"as all_rows_average from {src}")


TEAM_VS_AVERAGE = q("\nunion all\n".join([
    _tva("m1", "xg_per_match"), _tva("m2", "progressive_passes_per_match"),
    _tva("m2", "final_third_entries_per_match"), _tva("m3", "ppda"), _tva("m3", "counterpress_share"),
    _tva("m1", "set_piece_xg_share")]), "m1", "m2", "m3")

POSITION_GROUPS = q("""
select position_group, count(*) as n_players from (
  select case when primary_position = 'Goalkeeper' then 'Goalkeeper'
    when primary_position like '%Center Back%' then 'Center Back'
    when primary_position like '%Back%' then 'Fullback'
    when primary_position like '%Defensive Midfield%' then 'Defensive Mid'
    when primary_position like '%Attacking Midfield%' then 'Attacking Mid'
    when primary_position in ('Left Midfield', 'Right Midfield') then 'Winger'
    when primary_position like '%Midfield%' then 'Central Mid'
    when primary_position like '%Wing%' then 'Winger'
    when primary_position is not null then 'Forward' end as position_group
  from m5) group by position_group""", "m5")

STATE_SUMMARY = q("""
select game_state, count(*) as n_team_matches,
  round(sum(round(minutes_in_state * 1000000.0)) / count(minutes_in_state) / 1000000.0, 1) as avg_minutes,
  round(sum(round(xg_per_minute * 1000000.0)) / count(xg_per_minute) / 1000000.0, 4) as avg_xg_per_min,
  round(sum(round(avg_field_position_x * 1000000.0)) / count(avg_field_position_x) / 1000000.0, 1) as mean_x
from m6 group by game_state""", "m6")

STATE_CONTRAST = q("""
select team_name, competition_name, losing as xg_per_min_losing, winning as xg_per_min_winning,
  round(losing - winning, 4) as delta
from (pivot (select team_name, competition_name, game_state, xg_per_minute from m6)
      on game_state in ('Losing' as losing, 'Winning' as winning) using max(xg_per_minute))
where losing + winning is not null
order by delta desc, team_name, competition_name nulls last limit 10""", "m6")

FIRST_VALUE_WINDOW = g.tl_sql(f"""
select match_id, abs_seconds as goal_seconds, team as scoring_team,
  first(home_team order by abs_seconds) over w as first_home_team, first(away_team order by abs_seconds) over w as first_away_team
from ev where {g.GOAL} window w as (partition by match_id)""")

EXPORT_MANIFEST = q("""
select 'mart_team_attack_quality' as export_name, count(*) as rows from m1
union all select 'mart_team_ball_progression', count(*) from m2
union all select 'mart_team_defensive_pressure', count(*) from m3
union all select 'mart_team_set_piece_effectiveness', count(*) from m4
union all select 'mart_player_impact', count(*) from m5
union all select 'mart_team_gamestate_behavior', count(*) from m6
union all select 'dim_team_competition', count(*) from (
  select distinct team_name, competition_name, competition_folder_name, season_year from m1)""",
                    "m1", "m2", "m3", "m4", "m5", "m6")

STAGE_RANK = with_fb("select * from team_outcomes", OUTCOMES_CTE)

ML_FEATURES = q("select * from ml_dataset", *FEAT, extra=(OUTCOMES_CTE, FEATURES_CTE))

ML_BASELINE = q("""
select cast(sum(n) as bigint) as n_samples, cast(max(n) as bigint) as majority_count,
  max(n) / sum(n) as baseline_accuracy
from (select outcome_class, count(*) as n from ml_dataset where outcome_class is not null group by outcome_class)""",
                *FEAT, extra=(OUTCOMES_CTE, FEATURES_CTE))

STRATIFIED_FOLDS = q("""
select team_comp_key, outcome_class,
  cast((row_number() over (partition by outcome_class order by md5(team_comp_key || ':42'), team_comp_key) - 1) % 5
       as integer) as fold
from ml_dataset where outcome_class is not null""", *FEAT, extra=(OUTCOMES_CTE, FEATURES_CTE))

DASHBOARD_LISTS = q("\nunion all\n".join([
    _board("overview_set_piece_share", "m4", "", "sp_xg_share_of_total",
           "sp_xg_share_of_total desc nulls last, team_comp_key", 12, TL),
    _board("overview_f3_entries", "m2", "", "final_third_entries_per_match",
           "final_third_entries_per_match desc nulls last, team_comp_key", 12, TL),
    _board("overview_lowest_ppda", "m3", "", "ppda", "ppda asc nulls last, team_comp_key", 15, TL),
    _board("players_top30", "(select *, player_name as p_name from m5)", "", "np_xg_per_90 + xa_per_90",
           "np_xg_per_90 + xa_per_90 desc nulls last, player_id, team_comp_key", 30,
           "team_comp_key, p_name as team_name, competition_name"),
]), "m2", "m3", "m4", "m5")

XG_VS_GOALS = q("""select team_comp_key, team_name, competition_name, xg_total, goals, xg_overperformance
from m1""", "m1")

SCORE_CHASERS = q("""
select team_name, competition_name, xg_losing, minutes_losing,
  round(xg_losing / nullif(minutes_losing, 0), 4) as xg_per_min_losing
from (select team_name, competition_name, sum(xg_raw) as xg_losing,
             sum(round(minutes_in_state * 10.0)) / 10.0 as minutes_losing
      from m6 where game_state = 'Losing' group by team_name, competition_name)
order by xg_per_min_losing desc nulls last, team_name, competition_name nulls last limit 10""", "m6")

DEEP_RUN_LINES = q("""
select m.team_comp_key, m.team_name, m.game_state,
  round(sum(round(m.avg_field_position_x * 1000000.0)) / count(m.avg_field_position_x) / 1000000.0, 1) as mean_x,
  count(*) as n_matches
from m6 m
where m.team_comp_key in (select team_comp_key from team_outcomes
                          order by max_stage_rank desc, team_comp_key limit 6)
group by m.team_comp_key, m.team_name, m.game_state""", "m6", extra=(OUTCOMES_CTE,))

FINDINGS = q("\nunion all\n".join([
    "select 'trophies_vs_xg' as board, rank() over (partition by competition_folder_name, season_year "
    f"order by xg_overperformance nulls last, team_comp_key) as rank, {TL}, cast(xg_overperformance as double) as metric_value "
    "from m1 semi join (from team_outcomes where outcome_class = 'Finalist') using (team_comp_key)",
    _board("set_piece_waste", "m4", "sp_shots_total >= 8", "sp_conversion_rate",
           "sp_conversion_rate asc nulls last, sp_xg_per_match desc nulls last, team_comp_key", 5, TL),
    _board("low_block", "m3", "matches_played >= 3", "ppda", "ppda desc nulls last, team_comp_key", 5, TL),
]), "m1", "m3", "m4", extra=(OUTCOMES_CTE,))
