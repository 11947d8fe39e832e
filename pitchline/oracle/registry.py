"""key -> DuckDB SQL text, for every query that SQL can express."""

from pitchline.oracle import bronze_sql as b
from pitchline.oracle import gamestate_sql as g
from pitchline.oracle import players_sql as p
from pitchline.oracle import products_sql as d
from pitchline.oracle import serving_sql as s
from pitchline.oracle import team_sql as t


def oracle_sql() -> dict[str, str]:
    return {
        "scaled_features": d.SCALED_FEATURES,
        "fold_sizes": d.FOLD_SIZES,
        "state_by_team": d.STATE_BY_TEAM,
        "class_distribution": d.CLASS_DISTRIBUTION,
        "finalists": d.FINALISTS,
        "tournament_matrix": d.TOURNAMENT_MATRIX,
        "findings_recap": d.FINDINGS_RECAP,
        "players_by_position": d.PLAYERS_BY_POSITION,
        "players_sliced": d.PLAYERS_SLICED,
        "catalog_sample": d.CATALOG_SAMPLE,
        "ml_export": d.ML_EXPORT,
        "check_symmetry_violation": d.CHECK_SYMMETRY_VIOLATION,
        "mart_attack_quality": t.MART_ATTACK_QUALITY,
        "mart_set_piece": t.MART_SET_PIECE,
        "mart_ball_progression": t.MART_BALL_PROGRESSION,
        "progression_actions": t.PROGRESSION_ACTIONS,
        "possession_flags": t.POSSESSION_FLAGS,
        "mart_defensive_pressure": t.MART_DEFENSIVE_PRESSURE,
        "match_sides": t.MATCH_SIDES,
        "opponent_zone_passes": t.OPPONENT_ZONE_PASSES,
        "matches_played": t.MATCHES_PLAYED_Q,
        "np_shots_filter": t.NP_SHOTS_FILTER,
        "conditional_aggs": t.CONDITIONAL_AGGS,
        "ratio_metrics": t.RATIO_METRICS,
        "events_timed": g.EVENTS_TIMED,
        "catalog_tables": g.CATALOG_TABLES,
        "mart_gamestate_bucketed": g.MART_GAMESTATE,
        "events_measured_clock": g.EVENTS_MEASURED_CLOCK,
        "ml_optimality": d.ML_OPTIMALITY,
        "ml_forest_nodes": d.ML_FOREST_NODES,
        "score_timeline": g.SCORE_TIMELINE,
        "score_segments": g.SCORE_SEGMENTS,
        "state_durations": g.STATE_DURATIONS,
        "gamestate_events": g.GAMESTATE_EVENTS,
        "interval_join": g.INTERVAL_JOIN,
        "mart_gamestate": g.MART_GAMESTATE,
        "check_symmetry": g.CHECK_SYMMETRY,
        "check_symmetry_strict": g.CHECK_SYMMETRY_STRICT,
        "score_reconcile": g.SCORE_RECONCILE,
        "lineup_segments": p.LINEUP_SEGMENTS,
        "player_minutes": p.PLAYER_MINUTES,
        "player_meta": p.PLAYER_META,
        "player_counts": p.PLAYER_COUNTS,
        "xa_self_join": p.XA_SELF_JOIN,
        "mart_player_impact": p.MART_PLAYER_IMPACT,
        "bronze_profile": b.BRONZE_PROFILE,
        "scan_sparse_union": b.SCAN_SPARSE_UNION,
        "scan_hive_partitions": b.SCAN_HIVE_PARTITIONS,
        "table_inventory": b.TABLE_INVENTORY,
        "flatten_location": b.FLATTEN_LOCATION,
        "flatten_lineups": b.FLATTEN_LINEUPS,
        "union_all_matches": b.UNION_ALL_MATCHES,
        "incremental_anti": b.INCREMENTAL_ANTI,
        "incremental_events": b.INCREMENTAL_EVENTS,
        "incremental_lineups": b.INCREMENTAL_LINEUPS,
        "quarantine_files": b.QUARANTINE_FILES,
        "quarantine_split": b.QUARANTINE_SPLIT,
        "stg_events": b.STG_EVENTS,
        "stg_matches": b.STG_MATCHES,
        "stg_competitions": b.STG_COMPETITIONS,
        "stg_lineups": b.STG_LINEUPS,
        "sink_roundtrip": b.SINK_ROUNDTRIP,
        "stream_incremental_landing": b.STREAM_INCREMENTAL_LANDING,
        "dashboard_lists": s.DASHBOARD_LISTS,
        "xg_vs_goals": s.XG_VS_GOALS,
        "score_chasers": s.SCORE_CHASERS,
        "deep_run_lines": s.DEEP_RUN_LINES,
        "findings": s.FINDINGS,
        "check_not_null": s.CHECK_NOT_NULL,
        "check_unique": s.CHECK_UNIQUE,
        "check_accepted": s.CHECK_ACCEPTED,
        "check_feature_nulls": s.CHECK_FEATURE_NULLS,
        "check_share_sum": s.CHECK_SHARE_SUM,
        "dim_team_competition": s.DIM_TEAM_COMPETITION,
        "leaderboards": s.LEADERBOARDS,
        "topk_players": s.TOPK_PLAYERS,
        "minmaxavg_minutes": s.MINMAXAVG_MINUTES,
        "team_vs_average": s.TEAM_VS_AVERAGE,
        "position_groups": s.POSITION_GROUPS,
        "state_summary": s.STATE_SUMMARY,
        "state_contrast": s.STATE_CONTRAST,
        "first_value_window": s.FIRST_VALUE_WINDOW,
        "export_manifest": s.EXPORT_MANIFEST,
        "stage_rank": s.STAGE_RANK,
        "ml_features": s.ML_FEATURES,
        "ml_baseline": s.ML_BASELINE,
        "stratified_folds": s.STRATIFIED_FOLDS,
    }
