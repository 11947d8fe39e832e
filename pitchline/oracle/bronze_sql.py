"""Oracle SQL for the bronze/silver queries: the landed data must read back as the FB view."""

from pitchline.oracle import team_sql as t
from pitchline.oracle.base import with_fb
from pitchline.sources.wide import LINEUP_RULES, LOCATION_Y, MATCH_RULES, RULES, rule


_DUCK = {"string": "varchar", "double": "double", "boolean": "boolean", "int": "integer", "bigint": "bigint"}


def _wide(name: str) -> str:
    """The rule of a further raw column in DuckDB, as text where the query prints text."""
    kind = RULES[name][1]
    sql = rule(name, "list_value")
    if kind.startswith("array"):
        return f"array_to_string(list_transform({sql}, lambda x: cast(x as varchar)), '|')"
    return f"lower(cast({sql} as varchar))" if name.endswith("_id") and kind == "double" else f"cast({sql} as {_DUCK[kind]})"


#: Locations as pairs of components, NULL where there is none.
POINT = {"location": "start_x", "pass_end_location": "case when event_type = 'Pass' then end_x end",
         "carry_end_location": "case when event_type = 'Carry' then end_x end"}


def _point_text(x: str) -> str:
    return f"({x})::varchar || '|' || ({LOCATION_Y})::varchar"


SCAN_SPARSE_UNION = with_fb(f"""
select event_id as id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, match_id, period, minute, second,
  possession_sequence as possession, team, coalesce(player_id::double::varchar, 'nan') as player_id,
  player_name as player, player_position as position, play_pattern, pass_outcome,
  if(event_type = 'Pass', coalesce(lower(pass_assisted_shot_id::double::varchar), 'nan'), null) as pass_assisted_shot_id,
  nullif(pass_shot_assist, false) as pass_shot_assist, xg as shot_expected_goals, shot_type, shot_outcome,
  nullif(counterpress, false) as counterpress, duel_type, dribble_outcome, event_type as type, competition, season,
  {", ".join(f"{_point_text(x)} as {n}" for n, x in POINT.items())},
  {", ".join(f'{_wide(n)} as "{n}"' for n in RULES)}
from fb""")

# Types of the raw columns that come from the football view, and those of one kind only.
BASE_TYPES = {"id": "bigint", "ts": "timestamp_ntz", "match_id": "bigint", "period": "int", "minute": "bigint", "second": "bigint",
              "possession": "bigint", "team": "string", "player_id": "double", "player": "string", "position": "string",
              "play_pattern": "string", "location": "array<double>", "pass_end_location": "array<double>", "pass_outcome": "string",
              "pass_assisted_shot_id": "double", "pass_shot_assist": "boolean", "carry_end_location": "array<double>",
              "shot_expected_goals": "double", "shot_type": "string", "shot_outcome": "string", "counterpress": "boolean",
              "duel_type": "string", "dribble_outcome": "string"}
ONE_KIND = ("pass_", "carry_", "shot_", "counterpress", "duel_", "dribble_")


def _profile(name: str, kind: str, groups: int) -> str:
    c = f'"{name}"'
    text = f"min({c})" if kind == "string" else "null::varchar"
    return (f"select '{name}' as column_name, '{kind}' as data_type, count({c}) as non_null, "
            f"round(1 - count({c}) / count(*), 6) as null_share, {text} as sample_value, "
            f"{groups}::bigint as file_groups_with_column from landed")


BRONZE_PROFILE = (f"with landed as materialized ({SCAN_SPARSE_UNION}) " + " union all ".join(
    [_profile(n, t, 1 if n.startswith(ONE_KIND) else 8) for n, t in BASE_TYPES.items()]
    + [_profile(n, t, 8 if k is None else 1) for n, (k, t, _) in RULES.items()]))

SCAN_HIVE_PARTITIONS = with_fb("""
select event_type as type, competition, season, count(*) as n_events, count(distinct match_id) as n_matches
from fb group by all""")

TABLE_INVENTORY = "\nunion all\n".join(
    f"select '{n}' as table_name, count(*) as row_count from {n}"
    for n in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"])

def _parts(name: str, axes: str) -> str:
    sql = rule(name, "list_value")
    return ", ".join(f"({sql})[{i}] as {name}_{x}" for i, x in enumerate(axes, 1))


ENDS = ", ".join(
    [f"{POINT[n]} as {n}_x, if({POINT[n]} is null, null, {LOCATION_Y}) as {n}_y" for n in ("pass_end_location", "carry_end_location")]
    + [_parts("shot_end_location", "xyz"), _parts("goalkeeper_end_location", "xy")])

FLATTEN_LOCATION = with_fb(f"select event_id as id, {ENDS} from fb")

#: Nested positions and cards as the queries print them.
POSITIONS = ("array_to_string(list_transform(positions, lambda p: concat_ws(',', p['from'], coalesce(p['to'], 'null'), "
             "p['from_period'], coalesce(p['to_period']::varchar, 'null'))), '|')")
CARDS = "array_to_string(list_transform({}, lambda x: coalesce(x, 'null')), '|')".format(
    LINEUP_RULES["cards"][1].replace("ARR(", "list_value("))
PLAYER = {n: LINEUP_RULES[n][1] for n in ("player_nickname", "jersey_number", "country")}

FLATTEN_LINEUPS = with_fb(f"""
select match_id, competition_folder_name as competition, season_year as season, team_name,
  lower(player_id::double::varchar) as player_id, player_name, {", ".join(f"{sql} as {n}" for n, sql in PLAYER.items())},
  {CARDS} as cards, {POSITIONS} as positions
from fb_lineups""")

#: How a further raw match column is staged, where that is more than its value.
MATCH_STAGED = {
    "kick_off": "{} as kick_off_time", "stadium": "{} as stadium_name", "referee": "nullif({}, 'nan') as referee_name",
    "last_updated": "strftime(cast({} as timestamp), '%Y-%m-%d %H:%M:%S.%f') as last_updated_at",
    "referee_id": "try_cast(nullif({}, 'nan'::double) as bigint) as referee_id",
    "referee_country_id": "try_cast(nullif({}, 'nan'::double) as bigint) as referee_country_id",
    **{f"{s}_manager_nickname": f"nullif({{}}, 'nan') as {s}_manager_nickname" for s in ("home", "away")},
    **{f"{s}_manager_dob": f"cast({{}} as date) as {s}_manager_dob" for s in ("home", "away")}}
_MATCH_COLUMNS = ", ".join(MATCH_STAGED.get(n, f"cast({{}} as {_DUCK[t]}) as {n}").format(sql) for n, (t, sql) in MATCH_RULES.items())

STG_MATCHES_Q = f"""
select match_id, competition_folder_name, season_year, match_date, home_team_name, away_team_name,
  home_score, away_score, competition_stage_name, {_MATCH_COLUMNS}
from fb_matches"""

UNION_ALL_MATCHES = with_fb(STG_MATCHES_Q)
STG_MATCHES = with_fb(STG_MATCHES_Q)

INCREMENTAL_ANTI = with_fb("""
select match_id, competition_folder_name, season_year from fb_matches
where match_id not in (select match_id from fb where season = 2022)""")

INCREMENTAL_EVENTS = SCAN_SPARSE_UNION

INCREMENTAL_LINEUPS = FLATTEN_LINEUPS

QUARANTINE_FILES = with_fb("""
select match_id, 'landed' as outcome, events, players
from (select match_id, count(*) as events from fb group by match_id)
join (select match_id, count(*) as players from fb_lineups group by match_id) using (match_id)
where match_id not in (1, 2)
union all
select distinct match_id, case match_id when 1 then 'unreadable events' else 'unreadable lineups' end, null, null
from fb where match_id in (1, 2)""")

QUARANTINE_SPLIT = with_fb("""
select outcome, count(*) as rows from (
  select case when start_x is null then 'missing_location'
              when period not between 1 and 4 then 'shootout_period'
              when player_id is null then 'missing_player'
              else 'accepted' end as outcome
  from fb) group by outcome""")

#: Silver names of the further raw columns that get another one.
SILVER_NAME = {"index": "event_index", "timestamp": "match_time", "out": "is_out", "50_50": "fifty_fifty",
               "pass_recipient": "pass_recipient_name", "ball_recovery_recovery_failure": "ball_recovery_failure",
               "substitution_replacement": "substitution_replacement_name"}


def _staged(name: str) -> str:
    kind, sql = RULES[name][1], rule(name, "list_value")
    if kind == "boolean":
        sql = f"coalesce({sql}, false)"
    elif kind == "double" and name.endswith("_id"):
        sql = f"try_cast(nullif({sql}, 'nan'::double) as bigint)"
    else:
        sql = _wide(name)
    return f"{sql} as {SILVER_NAME.get(name, name)}"


STG_EVENTS = with_fb(f"""
select event_id, match_id, competition, season, period, minute, second, event_type, possession_sequence,
  team, player_id, player_name, player_position, play_pattern, start_x, end_x, pass_outcome,
  pass_assisted_shot_id, pass_shot_assist, xg, shot_type, shot_outcome, counterpress, duel_type, dribble_outcome,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, {_point_text("start_x")} as location, {ENDS},
  {", ".join(_staged(n) for n in RULES if not n.endswith("_location"))}
from fb""")

_OF_COMPETITION = ", ".join(f"cast({MATCH_RULES[n][1]} as {_DUCK[MATCH_RULES[n][0]]}) as {n}" for n in (
    "competition_id", "competition_name", "competition_country_name", "season_id"))
STG_COMPETITIONS = with_fb(f"select competition_folder_name, season_year, {_OF_COMPETITION} from fb_matches group by all")

STG_LINEUPS = with_fb(f"""
select match_id, competition_folder_name, season_year, team_name, player_id, player_name,
  nullif({PLAYER["player_nickname"]}, 'nan') as player_nickname, {PLAYER["jersey_number"]} as jersey_number,
  {PLAYER["country"]} as player_country, {CARDS} as cards, {POSITIONS} as positions
from fb_lineups""")

SINK_ROUNDTRIP = t.MART_ATTACK_QUALITY

STREAM_INCREMENTAL_LANDING = with_fb("""
select competition, season, count(*) as n_events, count(distinct event_id) as n_distinct_events,
  count(distinct match_id) as n_matches
from fb group by competition, season""")
