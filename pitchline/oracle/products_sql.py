"""Oracle SQL for the dashboard's and the scripts' further tables."""

from pitchline.oracle.serving_sql import FEAT, FEATURES_CTE, OUTCOMES_CTE, q

STATE_BY_TEAM = q("""
select team_name, competition_name, game_state, round(x, 2) as total_xg, round(m, 0) as total_minutes,
  round(x / nullif(m, 0), 4) as xg_per_minute
from (select team_name, competition_name, game_state, sum(xg_raw) as x,
             sum(minutes_in_state::decimal(20, 4))::double as m from m6 group by all)""", "m6")

CLASS_DISTRIBUTION = q("select outcome_class, count(*) as teams from team_outcomes group by all", extra=(OUTCOMES_CTE,))

FINALISTS = q("""
select team_name, competition_folder_name, season_year, outcome_class
from team_outcomes where max_stage_rank = 6""", extra=(OUTCOMES_CTE,))

TOURNAMENT_MATRIX = q("""
select team_comp_key, m1.team_name, m1.competition_name, m1.season_year, m1.matches_played, xg_per_match,
  final_third_entries_per_match, progressive_passes_per_match, ppda, sp_xg_per_match
from m1 left join m2 using (team_comp_key) left join m3 using (team_comp_key) left join m4 using (team_comp_key)""",
                      "m1", "m2", "m3", "m4")

FINDINGS_RECAP = q("""
select 'game_state_arc' as finding, game_state as subject,
  round(cast(sum(avg_field_position_x::decimal(20, 6)) as double) / count(avg_field_position_x), 1) as value
from m6 group by game_state
union all
select * from (select 'creators', concat_ws('|', player_name, team_comp_key), xa_per_90 from m5
               order by xa_per_90 desc nulls last, player_id, team_comp_key limit 5)""", "m5", "m6")


def _players(where: str) -> str:
    return q(f"""
select primary_position, row_number() over w as rank, player_id, player_name, team_comp_key, threat_per_90
from (select *, round(np_xg_per_90 + xa_per_90, 2) as threat_per_90 from m5 {where})
window w as (partition by primary_position order by threat_per_90 desc nulls last, player_id, team_comp_key)
qualify rank <= 3""", "m5")


PLAYERS_BY_POSITION = _players("")
PLAYERS_SLICED = _players("where primary_position = 'Center Forward' and competition_folder_name = 'comp_1'")

#: Each table's order and its columns by how they are shown: as they are (w), in thousandths (d),
#: as a time (t), as text (s) or by their number of values (a).
_SAMPLES = {
    "region": ("r_regionkey", "r_regionkey:w r_name:s"),
    "nation": ("n_nationkey", "n_nationkey:w n_name:s n_regionkey:w"),
    "customer": ("c_custkey", "c_custkey:w c_name:s c_nationkey:w c_acctbal:d c_mktsegment:s"),
    "supplier": ("s_suppkey", "s_suppkey:w s_name:s s_nationkey:w s_acctbal:d"),
    "part": ("p_partkey", "p_partkey:w p_name:s p_brand:s p_type:s p_size:w p_retailprice:d"),
    "orders": ("o_orderkey", "o_orderkey:w o_custkey:w o_orderstatus:s o_totalprice:d o_orderdate:t o_orderpriority:s"),
    "lineitem": ("l_orderkey, l_linenumber, l_partkey, l_suppkey", "l_orderkey:w l_partkey:w l_suppkey:w l_linenumber:w l_quantity:d "
                 "l_extendedprice:d l_discount:d l_tax:d l_returnflag:s l_linestatus:s l_shipdate:t"),
    "events": ("event_id", "event_id:w ts:t user_id:w event_type:s value:d props:s"),
    "documents": ("doc_id", "doc_id:w text:s lang:s source:s n_chars:w"),
    "embeddings": ("vec_id", "vec_id:w embedding:a label:w"),
    "pages": ("page_id", "page_id:w url:s html:s"),
    "benchmark": ("item_id", "item_id:w text:s"),
    "labels": ("doc_id", "doc_id:w quality:w toxic:w"),
    "conversations": ("conv_id, turn", "conv_id:w turn:w role:s text:s"),
}
_SHOWN = {"w": "{}::varchar", "d": "floor({} * 1000 + 0.5)::bigint::varchar", "t": "strftime({}, '%Y-%m-%d %H:%M:%S.%f')",
          "s": "if(length({0}) <= 40, {0}, length({0}) || ' ' || md5({0}))", "a": "len({}) || ' values'"}


def _sample(table: str, order: str, columns: str) -> str:
    shown = ", ".join("ifnull({}, 'null')".format(_SHOWN[kind].format(f'"{name}"')) for name, kind in (c.split(":") for c in columns.split()))
    return (f"(select '{table}' as table_name, row_number() over (order by {order}) as place, concat_ws('|', {shown}) as row "
            f"from {table} order by {order} limit 5)")


CATALOG_SAMPLE = " union all ".join(_sample(t, *x) for t, x in _SAMPLES.items())

ML_EXPORT = q("from ml_dataset", *FEAT, extra=(OUTCOMES_CTE, FEATURES_CTE))

CHECK_SYMMETRY_VIOLATION = q("""
select match_id from m6 where match_id % 3 = 0 group by match_id
having abs(coalesce(sum(minutes_in_state + 5) filter (game_state = 'Winning'), 0)
           - coalesce(sum(minutes_in_state) filter (game_state = 'Losing'), 0)) > 1""", "m6")

# The model's features.
_FEATURES = """shots_per_match xg_per_match xg_per_shot open_play_xg_share set_piece_xg_share progressive_passes_per_match
progressive_carries_per_match final_third_entries_per_match progressive_pass_completion_rate final_third_to_shot_rate
pressures_per_match high_press_share counterpress_share ppda high_press_regain_rate sp_xg_per_match sp_conversion_rate""".split()

SCALED_FEATURES = q(f"""
select team_comp_key, {", ".join(f"round(coalesce(({c} - avg({c}) over ()) / nullif(stddev_samp({c}) over (), 0), 0.0), 5) as {c}" for c in _FEATURES)}
from (select team_comp_key, {", ".join(f"coalesce({c}, 0.0) as {c}" for c in _FEATURES)} from ml_dataset
      where outcome_class is not null)""", *FEAT, extra=(OUTCOMES_CTE, FEATURES_CTE))

#: What holds of a fitted model whatever its coefficients: the loss is at its optimum, and the nodes say what the model says.
ML_OPTIMALITY = q(f"""
select count(*) as n_rows, count(distinct outcome_class) as n_classes, {len(_FEATURES)}::bigint as n_features, true as optimal
from ml_dataset where outcome_class is not null""", *FEAT, extra=(OUTCOMES_CTE, FEATURES_CTE))

ML_FOREST_NODES = q(f"""
select unnest({_FEATURES}) as subject, true as agrees
union all
select team_comp_key, true from ml_dataset where outcome_class is not null""", *FEAT, extra=(OUTCOMES_CTE, FEATURES_CTE))

FOLD_SIZES = q("""
select cast(fold as integer) as fold, outcome_class, count(*) as teams
from (select outcome_class, (row_number() over (partition by outcome_class order by md5(concat(team_comp_key, ':42')), team_comp_key) - 1) % 5 as fold
      from ml_dataset where outcome_class is not null)
group by all""", *FEAT, extra=(OUTCOMES_CTE, FEATURES_CTE))
