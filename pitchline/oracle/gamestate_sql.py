"""Oracle SQL for the score timeline and the game-state mart (DuckDB).

Everything follows from one list per match, the goals with their second and team. The score at any
second is the number of list entries up to it, so the state of an event is read off the list, with
no timeline join; segments are the gaps between the list's distinct seconds.

Shared conventions (documented in the README): goals in one second form one score change, and
state minutes are whole seconds summed, then divided by 60.
"""

from pitchline.oracle.base import with_fb

GOAL = "event_type = 'Shot' and shot_outcome = 'Goal'"


def tally(team: str, upto: str) -> str:
    """Goals of a team up to a second, from the match's list ``gl``."""
    return f"len(list_filter(gl, lambda g: g.t <= {upto} and g.side = {team}))"


def state(team: str, upto: str) -> str:
    other = f"if({team} = home_team, away_team, home_team)"
    return f"['Losing', 'Drawing', 'Winning'][2 + sign({tally(team, upto)} - {tally(other, upto)})]"


TIMELINE_CTES = [
    """ev as (
  select e.* exclude (home_team, away_team), home_team_name as home_team, away_team_name as away_team,
         60 * minute + second + 2700 * least(period - 1, 2) + 900 * cast(period = 4 as integer) as abs_seconds
  from fb e natural join (select match_id, home_team_name, away_team_name from fb_matches)
  where period in (1, 2, 3, 4) and minute + second is not null)""",
    f"""board as (
  select match_id, home_team, away_team, max(abs_seconds) as final_second,
         coalesce(list({{'t': abs_seconds, 'side': team}}) filter (where {GOAL}), []) as gl
  from ev group by match_id, home_team, away_team)""",
    """changes as (select *, list_sort(list_distinct(list_transform(gl, lambda g: g.t))) as flips from board)""",
    f"""spt as (
  select match_id, cast(list_prepend(0, flips)[i] as double) as seg_start,
         cast(list_append(flips, final_second)[i] as double) as seg_end,
         (seg_end - seg_start) / 60.0 as duration_minutes, team,
         {state('team', 'if(i = 1, -1, flips[i - 1])')} as game_state
  from (select *, unnest(range(1, len(flips) + 2)) as i from changes) cross join lateral (select unnest([home_team, away_team]) as team))""",
    f"""ec as (
  select ev.*, cast(coalesce(list_max(list_filter(flips, lambda x: x <= abs_seconds)), 0) as double) as seg_start,
         cast(coalesce(list_min(list_filter(flips, lambda x: x > abs_seconds)), final_second) as double) as seg_end,
         {state('team', 'abs_seconds')} as game_state
  from ev join (select match_id, gl, flips, final_second from changes) using (match_id)
  where team in (home_team, away_team) and abs_seconds < final_second)""",
]


def tl_sql(body: str, *more: str) -> str:
    return with_fb(body, *TIMELINE_CTES, *more)


EVENTS_TIMED = tl_sql("""select event_id, match_id, team, event_type, period, minute, second, abs_seconds,
  home_team, away_team from ev""")

SCORE_TIMELINE = tl_sql(f"""select match_id, goal_seconds, {tally('home_team', 'goal_seconds')} as home_score,
  {tally('away_team', 'goal_seconds')} as away_score
from (select *, unnest(flips) as goal_seconds from changes)""")

SCORE_SEGMENTS = tl_sql("from spt")

STATE_CTE = """sd as (
  select match_id, team, game_state, sum(seg_end - seg_start) / 60.0 as minutes_in_state from spt group by all)"""

STATE_DURATIONS = tl_sql("from sd", STATE_CTE)

CATALOG_TABLES = with_fb("""
select 'seconds' as table_name, 'EXTERNAL' as kind, count(*) as rows, count(distinct match_id) as matches
from (select distinct match_id, team, competition, season, period, minute * 60 + second as at from fb where period between 1 and 4
      union all select match_id, null, null, null, null, null from fb_matches)""")

EVENTS_MEASURED_CLOCK = with_fb("""
select event_id, match_id, period,
  minute * 60 + second + (select coalesce(sum(late + 1), 0)::bigint from
     (select max(e.minute * 60 + e.second) as late from fb e where e.match_id = fb.match_id and e.period < fb.period group by e.period)) as measured_seconds
from fb where period between 1 and 4 and minute is not null and second is not null""")

GAMESTATE_EVENTS = tl_sql("select event_id, match_id, team, abs_seconds, game_state from ec")

INTERVAL_JOIN = tl_sql("select event_id, match_id, team, seg_start, seg_end, game_state from ec")

#: One pile of segments and events, summed once: seconds from the former, counts from the latter.
MART_CTES = ["""pile as (
  select match_id, team, game_state, seg_end - seg_start as secs, null as competition, null as season, null as x,
         0.0 as xg, 0 as press, 0 as tries, 0 as hits, 0 as entry from spt
  union all
  select match_id, team, game_state, 0, competition, season, start_x,
         if(event_type = 'Shot' and shot_type <> 'Penalty', xg, 0.0), cast(event_type = 'Pressure' as integer),
         cast(event_type = 'Pass' as integer), cast(event_type = 'Pass' and pass_outcome is null as integer),
         cast(event_type in ('Pass', 'Carry') and start_x < 80 and end_x >= 80 as integer) from ec)""",
    """mart as (
  select concat_ws('|', team, competition_folder_name, season_year) as key_text, p.*, d.* from (
    select match_id, team, game_state, sum(secs) / 60.0 as mins, min(competition) as c, min(season) as s, avg(x) as x,
           coalesce(sum(xg), 0) as xg, sum(press)::bigint as press, sum(tries)::bigint as tries, sum(hits)::bigint as hits,
           coalesce(sum(entry), 0)::bigint as entry
    from pile group by all having mins >= 3.0) p
  left join fb_competitions d on (c, s) = (competition_folder_name, season_year))""",
    """rows_out as (
  select if(competition_folder_name is null, null, key_text) as team_comp_key, team as team_name, competition_name,
         competition_folder_name, season_year, match_id, game_state, round(mins, 1) as minutes_in_state,
         round(xg / mins, 4) as xg_per_minute, round(press / mins, 3) as pressures_per_minute,
         round(entry / mins, 3) as f3_entries_per_minute, round(hits / nullif(tries, 0), 3) as pass_completion_rate,
         round(x, 1) as avg_field_position_x, xg as xg_raw, press as pressures_raw, tries as passes_attempted,
         hits as passes_completed, entry as f3_entries_raw
  from mart)"""]

MART_CTE = ",\n".join(MART_CTES)

MART_GAMESTATE = tl_sql("from rows_out", MART_CTE)

CHECK_SYMMETRY = tl_sql("""
select match_id, w as total_winning_minutes, l as total_losing_minutes, abs(w - l) as diff
from (pivot (select match_id, game_state, minutes_in_state from rows_out where game_state <> 'Drawing')
      on game_state in ('Winning' as w0, 'Losing' as l0) using sum(minutes_in_state))
cross join lateral (select coalesce(w0, 0) as w, coalesce(l0, 0) as l)
where abs(w - l) > 1""", MART_CTE)

CHECK_SYMMETRY_STRICT = tl_sql("""
select match_id, team, if(team = home_team, away_team, home_team) as opponent, wins[team] as winning_minutes,
       losses[opponent] as opponent_losing_minutes, abs(winning_minutes - opponent_losing_minutes) as win_lose_diff
from (select match_id, home_team, away_team, unnest([home_team, away_team]) as team, wins, losses
      from board join (
        select match_id, map_from_entries(list((team, win))) as wins, map_from_entries(list((team, lose))) as losses
        from (select match_id, team, coalesce(sum(minutes_in_state) filter (game_state = 'Winning'), 0) as win,
                     coalesce(sum(minutes_in_state) filter (game_state = 'Losing'), 0) as lose
              from sd group by all) group by match_id) using (match_id))""", STATE_CTE)

SCORE_RECONCILE = tl_sql(f"""
select match_id, {tally('home_team', 'final_second')} as rebuilt_home, {tally('away_team', 'final_second')} as rebuilt_away,
  home_score::bigint as recorded_home, away_score::bigint as recorded_away,
  (rebuilt_home, rebuilt_away) = (recorded_home, recorded_away) as reconciled
from board join (select match_id, home_score, away_score from fb_matches) using (match_id)""")
