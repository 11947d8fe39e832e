"""Registered queries: data-quality checks, serving extracts, exports, outcome labels and ML."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchline.operators import quality as dq
from pitchline.operators import timeline as tl
from pitchline.plans import ml, outcomes, serving
from pitchline.plans.catalog import Tables, query
from pitchline.session import temporary_folder
from pitchline.sources.constraints import MARTS, SPECS
from pitchline.sources.warehouse import observed

col = F.col

EXPORT_NAMES = MARTS


def _observed(spark, sf, check: str) -> DataFrame:
    """A check's results for all tables, as observed while they were written."""
    Tables(spark, sf).marts()  # built, if they aren't yet
    return observed(spark, sf).where(col("check_name") == check)


@query("check_not_null")
def q_check_not_null(spark, sf):
    return _observed(spark, sf, "not_null")


@query("check_unique")
def q_check_unique(spark, sf):
    t = Tables(spark, sf)
    tables = {"stg_events": t.ev, "stg_matches": t.matches, "stg_competitions": t.comps}
    return dq.run_checks(tables, {n: dq.TableChecks(unique=SPECS[n].unique) for n in tables})


@query("check_accepted")
def q_check_accepted(spark, sf):
    return _observed(spark, sf, "accepted_values")


def _features(t: Tables) -> DataFrame:
    return outcomes.ml_features(outcomes.team_outcomes(t.matches), t.m1(), t.m2(), t.m3(), t.m4())


features_of = _features


@query("check_feature_nulls")
def q_check_feature_nulls(spark, sf):
    return dq.null_counts(_features(Tables(spark, sf)), {
        "missing_matches": "matches_played", "missing_xg": "xg_per_match",
        "missing_ppda": "ppda", "missing_sp_xg": "sp_xg_per_match"})


@query("check_share_sum")
def q_check_share_sum(spark, sf):
    """The five teams whose open-play + set-piece xG shares sum lowest (buckets are not exhaustive)."""
    m1 = Tables(spark, sf).m1()
    s = col("open_play_xg_share") + col("set_piece_xg_share")
    return (m1.select("team_comp_key", "team_name", "open_play_xg_share", "set_piece_xg_share",
                      s.alias("share_sum"))
            .orderBy(col("share_sum").asc_nulls_last(), col("team_comp_key")).limit(5))


@query("dim_team_competition")
def q_dim_team_competition(spark, sf):
    return serving.dim_team_competition(Tables(spark, sf).m1())


@query("leaderboards")
def q_leaderboards(spark, sf):
    t = Tables(spark, sf)
    return serving.team_leaderboards(t.m1(), t.reused("m2"), t.reused("m3"), t.reused("m4"))


@query("topk_players")
def q_topk_players(spark, sf):
    return serving.player_leaderboards(Tables(spark, sf).reused("m5"))


@query("minmaxavg_minutes")
def q_minmaxavg_minutes(spark, sf):
    return serving.minutes_distribution(Tables(spark, sf).m5())


@query("team_vs_average")
def q_team_vs_average(spark, sf):
    t = Tables(spark, sf)
    return serving.team_vs_average({"m1": t.reused("m1"), "m2": t.reused("m2"), "m3": t.reused("m3")})


@query("position_groups")
def q_position_groups(spark, sf):
    return serving.position_groups(Tables(spark, sf).m5())


@query("state_summary")
def q_state_summary(spark, sf):
    return serving.state_summary(Tables(spark, sf).m6())


@query("state_contrast")
def q_state_contrast(spark, sf):
    return serving.state_contrast(Tables(spark, sf).m6())


@query("first_value_window")
def q_first_value_window(spark, sf):
    """Each goal with its match's first home/away value; the window holds a match's goals only."""
    t = Tables(spark, sf)
    goals = tl.events_timed(t.ev.where(tl.goal_pred()), t.matches)
    w = Window.partitionBy("match_id").orderBy("abs_seconds")
    return goals.select("match_id", col("abs_seconds").alias("goal_seconds"), col("team").alias("scoring_team"),
                        F.first("home_team").over(w).alias("first_home_team"),
                        F.first("away_team").over(w).alias("first_away_team"))


@query("export_manifest")
def q_export_manifest(spark, sf):
    """Write the six marts and the team dimension as Parquet under the shared scratch folder and
    list the rows of each export, counted on their way to the files."""
    t = Tables(spark, sf)
    root = temporary_folder(spark, "exports")
    outputs = {EXPORT_NAMES[k]: df for k, df in t.marts().items()}
    outputs["dim_team_competition"] = serving.dim_team_competition(t.m1())
    none = dq.TableChecks()
    seen = [row for name, df in outputs.items()
            for row in dq.write_observed(name, df, none, lambda w, name=name: w.parquet(f"{root}/{name}.parquet"))]
    return dq.observed_table(spark, seen).select(col("table_name").alias("export_name"), col("failures").alias("rows"))


@query("stage_rank")
def q_stage_rank(spark, sf):
    return outcomes.team_outcomes(Tables(spark, sf).matches)


@query("ml_features")
def q_ml_features(spark, sf):
    return _features(Tables(spark, sf))


@query("ml_baseline")
def q_ml_baseline(spark, sf):
    return ml.majority_baseline(_features(Tables(spark, sf)))


@query("stratified_folds")
def q_stratified_folds(spark, sf):
    return ml.stratified_folds(_features(Tables(spark, sf))).select("team_comp_key", "outcome_class", "fold")


@query("ml_cv")
def q_ml_cv(spark, sf):
    return ml.cross_validate(_features(Tables(spark, sf)))


@query("ml_optimality")
def q_ml_optimality(spark, sf):
    return ml.optimality(_features(Tables(spark, sf))).select("n_rows", "n_classes", "n_features", "optimal")


@query("ml_forest_nodes")
def q_ml_forest_nodes(spark, sf):
    return ml.forest_agreement(_features(Tables(spark, sf)))


@query("ml_importance")
def q_ml_importance(spark, sf):
    """Random-forest importances; also written as CSV with a header (the original's export)."""
    imp = ml.feature_importance(_features(Tables(spark, sf)))
    imp.coalesce(1).write.mode("overwrite").option("header", True).csv(
        f"{temporary_folder(spark, "exports")}/feature_importance.csv")
    return imp


@query("dashboard_lists")
def q_dashboard_lists(spark, sf):
    t = Tables(spark, sf)
    return serving.dashboard_lists(t.m2(), t.m3(), t.m4(), t.m5())


@query("xg_vs_goals")
def q_xg_vs_goals(spark, sf):
    return serving.xg_vs_goals(Tables(spark, sf).m1())


@query("score_chasers")
def q_score_chasers(spark, sf):
    return serving.score_chasers(Tables(spark, sf).m6())


@query("deep_run_lines")
def q_deep_run_lines(spark, sf):
    t = Tables(spark, sf)
    return serving.deep_run_lines(t.m6(), outcomes.team_outcomes(t.matches))


@query("findings")
def q_findings(spark, sf):
    t = Tables(spark, sf)
    return serving.findings(t.m1(), t.m3(), t.m4(), outcomes.team_outcomes(t.matches))
