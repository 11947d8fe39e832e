"""The tables' constraints, checked while a table is written and by the check queries."""

from __future__ import annotations

from pitchline.operators.quality import TableChecks

# Accepted competitions of the FB view and accepted game states.
FB_COMPETITIONS = ["comp_0", "comp_1", "comp_2"]
GAME_STATES = ["Winning", "Drawing", "Losing"]

SPECS = {
    "stg_events": TableChecks(["event_id", "match_id", "competition", "event_type"], ["event_id"], {"competition": FB_COMPETITIONS}),
    "stg_matches": TableChecks(["match_id", "home_team_name", "away_team_name", "match_date"], ["match_id"]),
    "stg_competitions": TableChecks(["competition_name", "competition_folder_name"], ["competition_folder_name"]),
    "stg_lineups": TableChecks(["match_id", "player_id", "team_name"]),
    "mart_team_attack_quality": TableChecks(["team_name", "competition_name", "matches_played", "xg_per_match"]),
    "mart_team_ball_progression": TableChecks(["team_name", "progressive_passes_per_match"]),
    "mart_team_defensive_pressure": TableChecks(["team_name", "ppda"]),
    "mart_team_set_piece_effectiveness": TableChecks(["team_name", "sp_xg_per_match"]),
    "mart_player_impact": TableChecks(["player_id", "player_name", "minutes_played", "np_xg_per_90"]),
    "mart_team_gamestate_behavior": TableChecks(["team_name", "game_state", "minutes_in_state"], accepted_values={"game_state": GAME_STATES}),
}

#: The marts' names by their short ones.
MARTS = {"m1": "mart_team_attack_quality", "m2": "mart_team_ball_progression", "m3": "mart_team_defensive_pressure",
         "m4": "mart_team_set_piece_effectiveness", "m5": "mart_player_impact", "m6": "mart_team_gamestate_behavior"}
