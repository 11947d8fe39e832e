"""DuckDB text of the FB view and its derived tables, used as CTEs by every oracle query.

The oracle queries are written in DuckDB's own idiom (FILTER aggregates, list functions, ASOF
joins) and evaluated by a different engine with its own numeric and NULL semantics, so a match
between the two is evidence that both compute the intended thing.
"""

from __future__ import annotations

FB_CTES = """
fb_b as (
  select event_id, ts, user_id, event_type as et, value,
         cast(json_extract_string(props, '$.k') as int) as k,
         event_id // 250 as match_id, event_id % 250 as i
  from events),
fb_c as (
  select *, (match_id * 5) % 8 as hi, ((match_id * 5) % 8 + 1 + match_id % 7) % 8 as ai,
         i // 10 as poss,
         case when i < 240 then (i % 120) * 23 else 2737 + (i - 239) * 5 end as sip,
         case when et = 'error' then 'Pressure' when et = 'click' then 'Pass' when et = 'view' then 'Carry'
              when et = 'purchase' then case when k < 40 then 'Shot' else 'Duel' end
              when k % 3 = 0 then 'Ball Recovery' when k % 3 = 1 then 'Foul Committed' else 'Dribble' end as kind,
         case when k = 99 then null else cast((event_id * 37 + k * 11) % 121 as double) end as sx
  from fb_b),
fb_d as (select *, case when user_id % 2 = 0 then hi else ai end as ti from fb_c),
fb as (
select event_id, match_id, ts,
  concat('comp_', cast(match_id % 3 as varchar(9))) as competition,
  case when match_id % 3 = 0 then 2022 else 2024 end as season,
  case when i < 120 then 1 when i < 240 or match_id % 10 <> 0 then 2 else 5 end as period,
  sip // 60 as minute, sip % 60 as second,
  kind as event_type, poss as possession_sequence,
  concat('team_', cast(ti as varchar(9))) as team,
  concat('team_', cast(hi as varchar(9))) as home_team,
  concat('team_', cast(ai as varchar(9))) as away_team,
  case when user_id = 0 then null else ti * 100 + (user_id // 2) % 5 end as player_id,
  case when user_id = 0 then null else concat('P', cast(ti * 100 + (user_id // 2) % 5 as varchar(9))) end as player_name,
  case (user_id // 2 + case when k >= 90 then 1 else 0 end) % 5 when 0 then 'Goalkeeper' when 1 then 'Right Center Back'
       when 2 then 'Left Wing Back' when 3 then 'Center Attacking Midfield' else 'Center Forward' end as player_position,
  case (match_id * 7 + poss) % 7 when 0 then 'Regular Play' when 1 then 'From Counter' when 2 then 'From Kick Off'
       when 3 then 'From Corner' when 4 then 'From Free Kick' when 5 then 'From Throw In'
       else 'From Goal Kick' end as play_pattern,
  sx as start_x,
  case when kind in ('Pass', 'Carry') and sx is not null
       then greatest(0.0, least(120.0, sx + (k % 40) - 8)) end as end_x,
  case when kind = 'Pass' and k % 4 = 0 then 'Incomplete' end as pass_outcome,
  case when kind = 'Pass' and k % 5 = 0 then event_id + 1 end as pass_assisted_shot_id,
  coalesce(kind = 'Pass' and k % 10 = 0, false) as pass_shot_assist,
  case when kind = 'Shot' then floor(value * 2) / 1024 end as xg,
  case when kind = 'Shot' then case when k % 13 = 0 then 'Penalty' when k % 13 = 1 then 'Free Kick'
       when k % 13 = 12 then null else 'Open Play' end end as shot_type,
  case when kind = 'Shot' then case when value >= 100 then 'Goal' else 'Saved' end end as shot_outcome,
  coalesce(kind = 'Pressure' and k % 5 = 0, false) as counterpress,
  case when kind = 'Duel' then case when k % 2 = 0 then 'Tackle' else 'Aerial Lost' end end as duel_type,
  case when kind = 'Dribble' then case when k % 2 = 0 then 'Complete' else 'Incomplete' end end as dribble_outcome
from fb_d),
fb_matches as (
  select m.*,
         case (match_id // 3) % 6 when 0 then 'Group Stage' when 1 then 'Round of 16'
              when 2 then 'Quarter-finals' when 3 then 'Semi-finals' when 4 then '3rd Place Final'
              else 'Final' end as competition_stage_name
  from (
    select match_id, min(competition) as competition_folder_name, min(season) as season_year,
           min(home_team) as home_team_name, min(away_team) as away_team_name,
           cast(min(ts) as date) as match_date,
           cast(count(*) filter (where event_type = 'Shot' and shot_outcome = 'Goal'
                 and period between 1 and 4 and team = home_team) as integer) as home_score,
           cast(count(*) filter (where event_type = 'Shot' and shot_outcome = 'Goal'
                 and period between 1 and 4 and team = away_team) as integer) as away_score
    from fb group by match_id) m),
fb_competitions as (
  select distinct competition as competition_folder_name, season as season_year,
         upper(competition) as competition_name
  from fb),
fb_lineups as (
  select l.*, concat('P', cast(player_id as varchar)) as player_name,
         case when player_id % 7 = 0
                then cast([] as struct("from" varchar, "to" varchar, from_period integer, to_period integer)[])
              when player_id % 3 = 0
                then [{'from': '00:00', 'to': '60:00', 'from_period': 1, 'to_period': 2},
                      {'from': '60:00', 'to': null, 'from_period': 2, 'to_period': null}]
              else [{'from': '00:00', 'to': null, 'from_period': 1, 'to_period': null}] end as positions
  from (select distinct match_id, competition as competition_folder_name, season as season_year,
               team as team_name, player_id
        from fb where player_id is not null) l)
"""


def with_fb(body: str, *extra_ctes: str) -> str:
    """Prefix ``body`` with the FB CTEs and any extra ``name as (...)`` CTE texts."""
    ctes = FB_CTES.strip()
    for e in extra_ctes:
        ctes += ",\n" + e.strip()
    return f"with {ctes}\n{body.strip()}"
