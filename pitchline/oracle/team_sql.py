"""Oracle SQL for the team-grain marts (DuckDB).

Written as single-pass FILTER aggregates per team; M2 is rolled up from a possession-grain table
and M3's opponent passes come from per-(match, team) rows joined through the match pairing.
DuckDB evaluates it with its own semantics (decimal literals, HUGEINT sums, rounding), which is
what makes the comparison with the Spark plans meaningful.
"""

from pitchline.oracle.base import with_fb

NP = "event_type = 'Shot' and shot_type <> 'Penalty'"
KEY = "t.team || '|' || d.competition_folder_name || '|' || cast(d.season_year as varchar)"
DIM = "join fb_competitions d on d.competition_folder_name = t.competition and d.season_year = t.season"
LABELS = f"{KEY} as team_comp_key, t.team as team_name, d.competition_name, d.competition_folder_name, d.season_year"

MART_ATTACK_QUALITY = with_fb(f"""
select {LABELS},
  t.matches_played, t.shots_total,
  round(t.shots_total / t.matches_played, 2) as shots_per_match,
  round(t.xg, 2) as xg_total,
  round(t.xg / t.matches_played, 2) as xg_per_match,
  round(t.xg / nullif(t.shots_total, 0), 3) as xg_per_shot,
  t.goals,
  round(t.goals - t.xg, 2) as xg_overperformance,
  round(t.xg_open / nullif(t.xg, 0), 3) as open_play_xg_share,
  round(t.xg_sp / nullif(t.xg, 0), 3) as set_piece_xg_share
from per_team t {DIM}
where t.shots_total > 0""", f"""per_team as (
  select team, competition, season,
    count(distinct match_id) as matches_played,
    count(*) filter (where {NP}) as shots_total,
    sum(xg) filter (where {NP}) as xg,
    count(*) filter (where {NP} and shot_outcome = 'Goal') as goals,
    sum(if(play_pattern in ('Regular Play', 'From Counter', 'From Kick Off'), xg, 0)) filter (where {NP}) as xg_open,
    sum(if(play_pattern in ('From Corner', 'From Free Kick'), xg, 0)) filter (where {NP}) as xg_sp
  from fb group by all)""")

SP = f"{NP} and play_pattern in ('From Corner', 'From Free Kick', 'From Throw In')"
MART_SET_PIECE = with_fb(f"""
select {LABELS},
  t.matches_played,
  round(t.sp_xg / t.matches_played, 2) as sp_xg_per_match,
  round(t.sp_goals / t.matches_played, 2) as sp_goals_per_match,
  round(t.sp_shots_total / t.matches_played, 2) as sp_shots_per_match,
  round(t.sp_xg / nullif(t.sp_shots_total, 0), 3) as sp_xg_per_shot,
  round(t.sp_goals / nullif(t.sp_shots_total, 0), 3) as sp_conversion_rate,
  round(t.sp_xg / nullif(t.np_xg, 0), 3) as sp_xg_share_of_total,
  t.sp_shots_total, round(t.sp_xg, 2) as sp_xg_total, t.sp_goals, round(t.np_xg, 2) as total_xg
from per_team t {DIM}
where t.sp_shots_total > 0""", f"""per_team as (
  select team, competition, season,
    count(distinct match_id) as matches_played,
    count(*) filter (where {SP}) as sp_shots_total,
    sum(xg) filter (where {SP}) as sp_xg,
    count(*) filter (where {SP} and shot_outcome = 'Goal') as sp_goals,
    sum(xg) filter (where {NP}) as np_xg
  from fb group by all)""")

# --------------------------------------------------------------------- ball progression (M2)
LOCATED = "event_type in ('Pass', 'Carry') and start_x is not null"
PROG = f"{LOCATED} and end_x - start_x >= 10 and end_x >= 80"
PA_CTE = f"""pa as (
  select team, competition, season, match_id, event_id, event_type, start_x, end_x,
    cast(coalesce(end_x - start_x >= 10 and end_x >= 80, false) as integer) as is_progressive,
    cast(coalesce(start_x < 80 and end_x >= 80, false) as integer) as is_final_third_entry,
    if(event_type = 'Pass', cast(pass_outcome is null as integer), null) as is_completed_pass
  from fb where {LOCATED})"""
POSS_CTE = f"""poss as (
  select team, competition, season, match_id, possession_sequence,
    cast(coalesce(bool_or(start_x >= 80), false) as integer) as reached_final_third,
    cast(bool_or(event_type = 'Shot') as integer) as ended_with_shot,
    count(*) filter (where {LOCATED}) as n_actions,
    count(*) filter (where {PROG} and event_type = 'Pass') as prog_passes,
    count(*) filter (where {PROG} and event_type = 'Carry') as prog_carries,
    count(*) filter (where {LOCATED} and start_x < 80 and end_x >= 80) as entries,
    count(*) filter (where {PROG} and event_type = 'Pass' and pass_outcome is null) as prog_completed
  from fb group by all)"""

PROGRESSION_ACTIONS = with_fb("select * from pa", PA_CTE)
POSSESSION_FLAGS = with_fb("""select team, competition, season, match_id, possession_sequence,
  reached_final_third, ended_with_shot from poss""", POSS_CTE)

MART_BALL_PROGRESSION = with_fb(f"""
select {LABELS},
  t.matches_played,
  round(t.prog_passes / t.matches_played, 2) as progressive_passes_per_match,
  round(t.prog_carries / t.matches_played, 2) as progressive_carries_per_match,
  round(t.entries / t.matches_played, 2) as final_third_entries_per_match,
  round(t.prog_completed / nullif(t.prog_passes, 0), 3) as progressive_pass_completion_rate,
  round(t.f3_shot / nullif(t.f3, 0), 3) as final_third_to_shot_rate,
  t.prog_passes as progressive_passes, t.prog_carries as progressive_carries,
  t.entries as final_third_entries, t.f3 as possessions_reaching_f3, t.f3_shot as possessions_f3_with_shot
from (select team, competition, season,
        count(distinct match_id) filter (where n_actions > 0) as matches_played,
        sum(n_actions) as n_actions,
        cast(sum(prog_passes) as bigint) as prog_passes, cast(sum(prog_carries) as bigint) as prog_carries,
        cast(sum(entries) as bigint) as entries, sum(prog_completed) as prog_completed,
        cast(sum(reached_final_third) as bigint) as f3,
        count(*) filter (where reached_final_third = 1 and ended_with_shot = 1) as f3_shot
      from poss group by all) t {DIM}
where t.n_actions > 0""", POSS_CTE)

# --------------------------------------------------------------------- defensive pressure (M3)
PAIRS_CTE = """pairs as (
  select match_id, competition_folder_name as competition, season_year as season,
         unnest([home_team_name, away_team_name]) as team,
         unnest([away_team_name, home_team_name]) as opponent,
         unnest([true, false]) as is_home
  from fb_matches)"""
ZONE_CTE = """zone as (
  select match_id, competition, season, team, count(*) as n
  from fb where event_type = 'Pass' and start_x <= 72 group by all)"""
OPP_CTE = """opp as (
  select p.team, p.competition, p.season, sum(z.n) as opp_passes_in_zone_raw
  from pairs p join zone z on z.match_id = p.match_id and z.team = p.opponent
                          and z.competition = p.competition and z.season = p.season
  group by all)"""

MATCH_SIDES = with_fb("select * from pairs", PAIRS_CTE)
OPPONENT_ZONE_PASSES = with_fb("""select team, competition, season,
  cast(opp_passes_in_zone_raw as bigint) as opp_passes_in_zone_raw from opp""", PAIRS_CTE, ZONE_CTE, OPP_CTE)

PRESS = "event_type = 'Pressure'"
MART_DEFENSIVE_PRESSURE = with_fb(f"""
select {LABELS},
  t.matches_played,
  round(t.pressures_total / t.matches_played, 2) as pressures_per_match,
  round(t.pressures_high / nullif(t.pressures_total, 0), 3) as high_press_share,
  round(t.counterpresses_total / nullif(t.pressures_total, 0), 3) as counterpress_share,
  round(o.opp_passes_in_zone_raw / nullif(t.ppda_denom_raw, 0), 2) as ppda,
  round((t.pressures_total + t.duels + t.fouls + t.recoveries) / t.matches_played, 2) as defensive_actions_per_match,
  round(t.counterpresses_high / nullif(t.pressures_high, 0), 3) as high_press_regain_rate,
  t.pressures_total, t.pressures_high, t.counterpresses_total, t.counterpresses_high,
  cast(o.opp_passes_in_zone_raw as bigint) as opp_passes_in_zone_raw, t.ppda_denom_raw
from (select team, competition, season,
        count(distinct match_id) as matches_played,
        count(*) filter (where {PRESS}) as pressures_total,
        count(*) filter (where {PRESS} and start_x >= 60) as pressures_high,
        count(*) filter (where {PRESS} and counterpress) as counterpresses_total,
        count(*) filter (where {PRESS} and counterpress and start_x >= 60) as counterpresses_high,
        count(*) filter (where event_type = 'Duel') as duels,
        count(*) filter (where event_type = 'Foul Committed') as fouls,
        count(*) filter (where event_type = 'Ball Recovery') as recoveries,
        count(*) filter (where start_x >= 48 and (event_type in ('Pressure', 'Foul Committed')
                                  or (event_type = 'Duel' and duel_type = 'Tackle'))) as ppda_denom_raw
      from fb where start_x is not null group by all) t
join opp o on o.team = t.team and o.competition = t.competition and o.season = t.season
{DIM}""", PAIRS_CTE, ZONE_CTE, OPP_CTE)

# --------------------------------------------------------------------- building blocks
MATCHES_PLAYED_Q = with_fb("""
select team, competition, season, count(distinct match_id) as matches_played from fb group by all""")

NP_SHOTS_FILTER = with_fb(f"""
select event_id, match_id, team, xg, shot_type, shot_outcome, play_pattern from fb where {NP}""")

CONDITIONAL_AGGS_CTE = """ca as (
  select team, competition, season, count(*) as n_events,
    count(*) filter (where event_type = 'Pass') as passes,
    count(*) filter (where event_type = 'Pass' and pass_outcome is null) as passes_completed,
    count(*) filter (where event_type = 'Pressure') as pressures,
    count(*) filter (where event_type = 'Pressure' and counterpress) as counterpresses,
    count(*) filter (where event_type = 'Shot') as shots,
    count(*) filter (where event_type = 'Shot' and shot_type <> 'Penalty') as np_shots,
    coalesce(sum(xg) filter (where event_type = 'Shot'), 0) as xg_all,
    count(*) filter (where event_type = 'Dribble' and dribble_outcome = 'Complete') as dribbles_won,
    count(*) filter (where event_type = 'Duel' and duel_type = 'Tackle') as tackles
  from fb group by all)"""

CONDITIONAL_AGGS = with_fb("select * from ca", CONDITIONAL_AGGS_CTE)

RATIO_METRICS = with_fb("""
select team, competition, season,
  round(passes_completed / nullif(passes, 0), 3) as pass_completion,
  round(counterpresses / nullif(pressures, 0), 4) as counterpress_share,
  round(xg_all / nullif(shots, 0), 2) as xg_per_shot,
  round(dribbles_won / nullif(tackles - tackles, 0), 2) as always_null,
  round(n_events / 7, 1) as events_per_7,
  round(np_shots / nullif(shots, 0), 0) as np_share_r0
from ca""", CONDITIONAL_AGGS_CTE)
