"""The raw feed's further columns, which the driver's ``events`` table has no counterpart for.

Like the FB view itself they are a fixed deterministic mapping: each is a rule over the event id
and a few FB columns. The rules are fixture data, written in the SQL both Spark and DuckDB speak;
``ARR`` stands for the engine's array constructor. A column with an event kind is present only in
that kind's files.
"""

from __future__ import annotations


def _flag(n: int) -> str:
    """Sparse boolean: present where true only."""
    return f"case when event_id % {n} = 0 then true end"


def _one_of(n: int, *values: str) -> str:
    """A text by the event id; ids past the values have none."""
    return f"case event_id % {n} " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"


def _number(n: int, per: int) -> str:
    return f"cast(event_id % {n} as double) / {per}"


def _float_id(condition: str, value: str) -> str:
    """Raw ids arrive as floats with NaN for missing."""
    return f"case when {condition} then cast({value} as double) else cast('nan' as double) end"


_Y = "cast((event_id * 13) % 81 as double)"

#: Raw column -> (event kind or None for all, Spark type, rule).
RULES: dict[str, tuple[str | None, str, str]] = {
    "index": (None, "int", "cast(event_id % 250 + 1 as int)"),
    "timestamp": (None, "string", "concat('00:', lpad(cast(minute % 45 as varchar(9)), 2, '0'), ':', lpad(cast(second as varchar(9)), 2, '0'), '.000')"),
    "duration": (None, "double", f"case when event_id % 3 <> 0 then {_number(500, 100)} end"),
    "possession_team": (None, "string", "case when possession_sequence % 2 = 0 then home_team else away_team end"),
    "possession_team_id": (None, "int", "cast(replace(case when possession_sequence % 2 = 0 then home_team else away_team end, 'team_', '') as int)"),
    "team_id": (None, "int", "cast(replace(team, 'team_', '') as int)"),
    "under_pressure": (None, "boolean", _flag(4)),
    "off_camera": (None, "boolean", _flag(53)),
    "out": (None, "boolean", _flag(11)),
    "injury_stoppage_in_chain": (None, "boolean", _flag(97)),
    "related_events": (None, "array<string>", "case when event_id % 2 = 0 then ARR(cast(event_id + 1 as varchar(20)), cast(event_id + 2 as varchar(20))) end"),
    "tactics": (None, "array<string>", "case when event_id % 250 = 0 then ARR('formation 442', team) end"),
    "50_50": ("Duel", "string", _one_of(9, "Won", "Lost", "Success To Team")),
    "pass_length": ("Pass", "double", _number(400, 8)),
    "pass_angle": ("Pass", "double", "cast(event_id % 629 as double) / 100 - 3"),
    "pass_height": ("Pass", "string", _one_of(3, "Ground Pass", "Low Pass", "High Pass")),
    "pass_body_part": ("Pass", "string", _one_of(5, "Right Foot", "Left Foot", "Head", "Right Foot")),
    "pass_type": ("Pass", "string", _one_of(23, "Corner", "Free Kick", "Throw-in", "Goal Kick", "Kick Off")),
    "pass_technique": ("Pass", "string", _one_of(29, "Inswinging", "Outswinging", "Straight", "Through Ball")),
    "pass_recipient": ("Pass", "string", "case when event_id % 6 <> 0 then concat('P', cast(event_id % 800 as varchar(9))) end"),
    "pass_recipient_id": ("Pass", "double", _float_id("event_id % 6 <> 0", "event_id % 800")),
    "pass_cross": ("Pass", "boolean", _flag(13)),
    "pass_cut_back": ("Pass", "boolean", _flag(67)),
    "pass_switch": ("Pass", "boolean", _flag(17)),
    "pass_through_ball": ("Pass", "boolean", _flag(31)),
    "pass_goal_assist": ("Pass", "boolean", _flag(71)),
    "pass_aerial_won": ("Pass", "boolean", _flag(19)),
    "pass_deflected": ("Pass", "boolean", _flag(37)),
    "pass_inswinging": ("Pass", "boolean", _flag(41)),
    "pass_outswinging": ("Pass", "boolean", _flag(43)),
    "pass_miscommunication": ("Pass", "boolean", _flag(47)),
    "pass_no_touch": ("Pass", "boolean", _flag(59)),
    "pass_straight": ("Pass", "boolean", _flag(61)),
    "shot_body_part": ("Shot", "string", _one_of(4, "Right Foot", "Left Foot", "Head", "Other")),
    "shot_technique": ("Shot", "string", _one_of(6, "Normal", "Volley", "Half Volley", "Lob")),
    "shot_end_location": ("Shot", "array<double>", f"case when event_id % 5 = 0 then ARR(cast(120 as double), {_Y}) else ARR(cast(119 as double), {_Y}, {_number(32, 16)}) end"),
    "shot_key_pass_id": ("Shot", "string", "case when event_id % 2 = 1 then cast(event_id - 1 as varchar(20)) end"),
    "shot_first_time": ("Shot", "boolean", _flag(3)),
    "shot_one_on_one": ("Shot", "boolean", _flag(7)),
    "shot_deflected": ("Shot", "boolean", _flag(11)),
    "shot_aerial_won": ("Shot", "boolean", _flag(13)),
    "shot_freeze_frame": ("Shot", "array<string>", "case when event_id % 4 <> 0 then ARR(home_team, away_team, 'Goalkeeper') end"),
    "dribble_nutmeg": ("Dribble", "boolean", _flag(5)),
    "dribble_overrun": ("Dribble", "boolean", _flag(7)),
    "duel_outcome": ("Duel", "string", _one_of(4, "Won", "Lost In Play", "Success")),
    "interception_outcome": ("Pressure", "string", _one_of(5, "Won", "Lost Out")),
    "ball_receipt_outcome": ("Carry", "string", _one_of(8, "Incomplete")),
    "ball_recovery_recovery_failure": ("Ball Recovery", "boolean", _flag(6)),
    "block_deflection": ("Pressure", "boolean", _flag(7)),
    "block_offensive": ("Pressure", "boolean", _flag(11)),
    "block_save_block": ("Pressure", "boolean", _flag(13)),
    "clearance_body_part": ("Ball Recovery", "string", _one_of(5, "Head", "Left Foot", "Right Foot")),
    "clearance_aerial_won": ("Ball Recovery", "boolean", _flag(8)),
    "clearance_head": ("Ball Recovery", "boolean", _flag(5)),
    "clearance_left_foot": ("Ball Recovery", "boolean", _flag(9)),
    "clearance_right_foot": ("Ball Recovery", "boolean", _flag(10)),
    "clearance_other": ("Ball Recovery", "boolean", _flag(12)),
    "goalkeeper_type": ("Duel", "string", _one_of(7, "Shot Faced", "Shot Saved", "Collected")),
    "goalkeeper_outcome": ("Duel", "string", _one_of(7, "Success", "Fail")),
    "goalkeeper_body_part": ("Duel", "string", _one_of(7, "Both Hands", "Right Foot")),
    "goalkeeper_position": ("Duel", "string", _one_of(7, "Set", "Moving", "Prone")),
    "goalkeeper_technique": ("Duel", "string", _one_of(7, "Diving", "Standing")),
    "goalkeeper_end_location": ("Duel", "array<double>", f"case when event_id % 7 < 3 then ARR({_number(16, 4)}, {_Y}) end"),
    "foul_committed_type": ("Foul Committed", "string", _one_of(6, "Handball", "Dive", "Foul Out")),
    "foul_committed_card": ("Foul Committed", "string", _one_of(10, "Yellow Card", "Red Card", "Second Yellow")),
    "foul_committed_advantage": ("Foul Committed", "boolean", _flag(7)),
    "foul_won_advantage": ("Foul Committed", "boolean", _flag(9)),
    "foul_won_defensive": ("Foul Committed", "boolean", _flag(5)),
    "miscontrol_aerial_won": ("Dribble", "boolean", _flag(9)),
    "substitution_outcome": ("Foul Committed", "string", _one_of(8, "Tactical", "Injury")),
    "substitution_outcome_id": ("Foul Committed", "double", _float_id("event_id % 8 < 2", "103 - event_id % 8")),
    "substitution_replacement": ("Foul Committed", "string", "case when event_id % 8 < 2 then concat('P', cast(event_id % 800 as varchar(9))) end"),
    "substitution_replacement_id": ("Foul Committed", "double", _float_id("event_id % 8 < 2", "event_id % 800")),
}



def _side(side: str, shift: int) -> dict[str, tuple[str, str]]:
    """The raw match columns of one side."""
    n, m = f"cast(replace({side}_team_name, 'team_', '') as int)", f"(match_id + {shift})"
    return {
        f"{side}_team_id": ("int", n),
        f"{side}_team_gender": ("string", "'male'"),
        f"{side}_team_group": ("string", f"case {m} % 5 when 0 then 'A' when 1 then 'B' when 2 then 'C' end"),
        f"{side}_team_country_id": ("int", f"{n} + 200"),
        f"{side}_team_country_name": ("string", f"concat('Country ', cast({n} as varchar(9)))"),
        f"{side}_manager_id": ("int", f"cast({m} % 40 + 1000 as int)"),
        f"{side}_manager_name": ("string", f"concat('Manager ', cast({m} % 40 as varchar(9)))"),
        f"{side}_manager_nickname": ("string", f"case when {m} % 3 = 0 then 'nan' else concat('Boss ', cast({m} % 40 as varchar(9))) end"),
        f"{side}_manager_dob": ("string", f"case when {m} % 9 <> 0 then concat('19', cast({m} % 40 + 50 as varchar(9)), '-0', cast({m} % 9 as varchar(9)), '-1', cast({m} % 10 as varchar(9))) end"),
        f"{side}_manager_country_id": ("int", f"cast({m} % 40 + 300 as int)"),
        f"{side}_manager_country_name": ("string", f"concat('Country ', cast({m} % 40 + 100 as varchar(9)))"),
    }


#: Raw match-metadata column -> (Spark type, rule over the FB match table).
MATCH_RULES: dict[str, tuple[str, str]] = {
    "competition_id": ("int", "cast(match_id % 3 + 40 as int)"),
    "season_id": ("int", "case when season_year = 2022 then 106 else 282 end"),
    "kick_off": ("string", "concat(cast(match_id % 12 + 10 as varchar(9)), ':00:00.000')"),
    "match_week": ("int", "cast(match_id % 7 + 1 as int)"),
    "competition_stage_id": ("int", "cast(floor(match_id / 3) as int) % 6 + 10"),
    "competition_name": ("string", "upper(competition_folder_name)"),
    "competition_country_name": ("string", "concat('Host of ', competition_folder_name)"),
    **_side("home", 0),
    **_side("away", 1),
    "stadium_id": ("int", "cast(match_id % 12 + 1 as int)"),
    "stadium": ("string", "case when match_id % 10 <> 9 then concat('Stadium ', cast(match_id % 12 + 1 as varchar(9))) end"),
    "stadium_country_id": ("int", "cast(match_id % 3 + 400 as int)"),
    "stadium_country_name": ("string", "concat('Country ', cast(match_id % 3 + 400 as varchar(9)))"),
    "referee_id": ("double", "case when match_id % 5 <> 0 then cast(match_id % 30 as double) else cast('nan' as double) end"),
    "referee": ("string", "case when match_id % 5 <> 0 then concat('Referee ', cast(match_id % 30 as varchar(9))) else 'nan' end"),
    "referee_country_id": ("double", "case when match_id % 5 <> 0 then cast(match_id % 8 as double) else cast('nan' as double) end"),
    "referee_country_name": ("string", "case when match_id % 5 <> 0 then concat('Country ', cast(match_id % 8 as varchar(9))) end"),
    "match_status": ("string", "'available'"),
    "match_status_360": ("string", "case when match_id % 2 = 0 then 'available' else 'scheduled' end"),
    "last_updated": ("string", "concat('2024-0', cast(match_id % 9 + 1 as varchar(9)), '-1', cast(match_id % 10 as varchar(9)), 'T10:', cast(match_id % 50 + 10 as varchar(9)), ':00.250000')"),
    "data_version": ("string", "'1.1.0'"),
    "shot_fidelity_version": ("string", "'2'"),
    "xy_fidelity_version": ("string", "'2'"),
}

#: Raw lineup column -> (Spark type, rule over the FB lineup table).
LINEUP_RULES: dict[str, tuple[str, str]] = {
    "player_nickname": ("string", "case when player_id % 2 = 0 then 'nan' else concat('Nick ', player_name) end"),
    "jersey_number": ("int", "cast(player_id % 23 + 1 as int)"),
    "country": ("string", "concat('Country ', cast(player_id % 11 as varchar(9)))"),
    "cards": ("array<string>", "case when player_id % 4 = 0 then ARR('Yellow Card', 'Foul Committed') else ARR(cast(null as varchar(9))) end"),
}

#: The second component of the locations that the FB view has an x for.
LOCATION_Y = _Y


def rule(name: str, array: str) -> str:
    """A column's rule as SQL, NULL outside its kind; ``array`` is the engine's constructor."""
    kind, _, sql = RULES[name]
    sql = sql.replace("ARR(", f"{array}(")
    return sql if kind is None else f"case when event_type = '{kind}' then {sql} end"
