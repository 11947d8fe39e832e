"""Oracle SQL for the player mart (DuckDB). A player's events are one list of small structs, from which
counts, xG and the modal position are taken by list functions; lineup segments of all matches are one
flat list; assisted shots are looked up in a map of each match's shots."""

from pitchline.oracle.base import with_fb

KEYS = "player_id, team, competition, season"
LINEUP_KEYS = "player_id, team_name as team, competition_folder_name as competition, season_year as season"


def clock(x: str) -> str:
    """Seconds of a text MM:SS."""
    return f"list_dot_product([60.0, 1.0], string_split({x}, ':')::double[])::integer"


def _upto(segment: str) -> str:
    return f"coalesce({segment}['to'], '120:00')"


def _length(segment: str) -> str:
    return f"{clock(_upto(segment))} - {clock(segment + chr(91) + chr(39) + 'from' + chr(39) + chr(93))}"


def _number(condition: str) -> str:
    return f"len(list_filter(acts, lambda e: {condition}))"


NON_PENALTY = "e.kind = 'Shot' and e.shot <> 'Penalty'"

MINUTES = f"""spells as (
  select {LINEUP_KEYS}, list(distinct match_id) as games, flatten(list(positions)) as parts
  from fb_lineups where len(positions) > 0 group by all),
minutes as (
  select {KEYS}, len(games) as matches_played, list_sum(list_transform(parts, lambda s: {_length("s")})) / 60.0 as total_minutes
  from spells)"""

FACTS = f"""acting as (
  select {KEYS}, any_value(player_name) as player_name,
         list(struct_pack(kind := event_type, shot := shot_type, result := coalesce(shot_outcome, dribble_outcome), worth := xg,
                          gain := end_x - start_x, until := end_x, place := player_position)) as acts
  from fb where player_id is not null group by all),
placed as (select *, list_filter(list_transform(acts, lambda e: e.place), lambda x: x is not null) as places from acting),
facts as (
  select {KEYS}, player_name,
    list_sort(list_transform(list_distinct(places), lambda x: {{'less': -len(list_filter(places, lambda y: y = x)), 'x': x}}))[1].x as primary_position,
    {_number(NON_PENALTY + " and e.result = 'Goal'")} as np_goals,
    coalesce(list_sum(list_transform(list_filter(acts, lambda e: {NON_PENALTY}), lambda e: e.worth)), 0) as np_xg,
    {_number("e.kind = 'Carry' and e.gain >= 10 and e.until >= 80")} as progressive_carries,
    {_number("e.kind = 'Dribble' and e.result = 'Complete'")} as successful_dribbles,
    {_number("e.kind = 'Pressure'")} as pressures, {_number("e.kind = 'Ball Recovery'")} as ball_recoveries
  from placed)"""

ASSISTS = f"""shot_map as (
  select match_id, map(list(event_id), list(xg)) as shots from fb where event_type = 'Shot' and shot_type <> 'Penalty' group by match_id),
assists as (
  select {KEYS}, sum(map_extract(shots, pass_assisted_shot_id)[1]) as total_xa
  from fb natural join shot_map
  where event_type = 'Pass' and pass_shot_assist and player_id is not null and map_contains(shots, pass_assisted_shot_id)
  group by all)"""

LINEUP_SEGMENTS = with_fb(f"""
select match_id, {LINEUP_KEYS}, part['from_period'] as from_period, part['to_period'] as to_period, part['from'] as from_ts,
  {_upto("part")} as to_ts, {_length("part")} as seg_seconds
from (select *, unnest(positions) as part from fb_lineups)""")
PLAYER_MINUTES = with_fb("from minutes", MINUTES)
PLAYER_META = with_fb(f"select {KEYS}, player_name, primary_position from facts", FACTS)
PLAYER_COUNTS = with_fb("select * exclude (player_name, primary_position) from facts", FACTS)
XA_SELF_JOIN = with_fb("from assists", ASSISTS)


def _rate(metric: str, name: str) -> str:
    return f"round({metric} * 90.0 / total_minutes, 2) as {name}"


MART_PLAYER_IMPACT = with_fb(f"""
select concat(team, '|', competition, '|', season::varchar) as team_comp_key, player_id, player_name, primary_position,
  team as team_name, competition_name, competition as competition_folder_name, season as season_year, matches_played,
  round(total_minutes, 0) as minutes_played, {_rate("np_goals", "np_goals_per_90")}, {_rate("np_xg", "np_xg_per_90")},
  {_rate("xa", "xa_per_90")}, {_rate("progressive_carries", "prog_carries_per_90")},
  {_rate("successful_dribbles", "successful_dribbles_per_90")}, {_rate("pressures", "pressures_per_90")},
  {_rate("ball_recoveries", "ball_recoveries_per_90")}, np_goals, round(np_xg, 2) as np_xg_total, round(xa, 2) as xa_total,
  progressive_carries, successful_dribbles, pressures, ball_recoveries
from (select f.*, m.matches_played, m.total_minutes, ifnull(a.total_xa, 0) as xa, c.competition_name
      from facts f natural join minutes m left join assists a using ({KEYS})
      join fb_competitions c on (c.competition_folder_name, c.season_year) = (f.competition, f.season))
where total_minutes >= 270""", MINUTES, FACTS, ASSISTS)
