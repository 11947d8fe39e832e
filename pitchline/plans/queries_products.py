"""Registered queries for the dashboard's and the scripts' further tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.functions.exprs import exact_mean, ratio
from pitchline.functions.exprs import round_half_away as rnd
from pitchline.plans import ml, outcomes
from pitchline.plans.catalog import Tables, query
from pitchline.plans.queries_serving import features_of
from pitchline.session import temporary_folder
from pitchline.sources import fb as fbsrc

col = F.col


def _dec(c: str):
    """One-decimal values as decimals, so that sums don't depend on their order."""
    return F.sum(col(c).cast("decimal(20,4)")).cast("double")


def state_by_team(m6: DataFrame, teams: list[str] | None = None) -> DataFrame:
    """Total xG, minutes and xG per minute of each team in each game state; ``teams`` selects."""
    rows = m6.where(col("team_name").isin(teams)) if teams else m6
    return rows.groupBy("team_name", "competition_name", "game_state").agg(
        F.sum("xg_raw").alias("_xg"), _dec("minutes_in_state").alias("_min")).select(
        "team_name", "competition_name", "game_state", rnd("_xg", 2).alias("total_xg"),
        rnd("_min", 0).alias("total_minutes"), rnd(ratio("_xg", "_min"), 4).alias("xg_per_minute"))


@query("state_by_team")
def q_state_by_team(spark, sf):
    return state_by_team(Tables(spark, sf).m6())


@query("class_distribution")
def q_class_distribution(spark, sf):
    o = outcomes.team_outcomes(Tables(spark, sf).matches)
    return o.groupBy("outcome_class").agg(F.count(F.lit(1)).alias("teams"))


@query("finalists")
def q_finalists(spark, sf):
    o = outcomes.team_outcomes(Tables(spark, sf).matches)
    return o.where(col("outcome_class") == "Finalist").select(
        "team_name", "competition_folder_name", "season_year", "outcome_class")


@query("tournament_matrix")
def q_tournament_matrix(spark, sf):
    """Key metrics of each team side by side, one row a tournament it played; a metric of a mart that
    lacks the team is NULL."""
    t = Tables(spark, sf)
    parts = [t.m2().select("team_comp_key", "final_third_entries_per_match", "progressive_passes_per_match"),
             t.m3().select("team_comp_key", "ppda"), t.m4().select("team_comp_key", "sp_xg_per_match")]
    base = t.m1().select("team_comp_key", "team_name", "competition_name", "season_year", "matches_played", "xg_per_match")
    return reduce(lambda a, b: a.join(b, "team_comp_key", "left"), parts, base)


@query("findings_recap")
def q_findings_recap(spark, sf):
    """The closing page's first and last findings: where teams stand in each game state, and the
    players who create most."""
    t = Tables(spark, sf)
    arc = t.m6().groupBy("game_state").agg(rnd(exact_mean("avg_field_position_x"), 1).alias("value")).select(
        F.lit("game_state_arc").alias("finding"), col("game_state").alias("subject"), "value")
    best = t.m5().orderBy(col("xa_per_90").desc_nulls_last(), "player_id", "team_comp_key").limit(5)
    return arc.unionByName(best.select(
        F.lit("creators").alias("finding"), F.concat_ws("|", "player_name", "team_comp_key").alias("subject"),
        col("xa_per_90").alias("value")))


def top_players(m5: DataFrame, k: int = 3, position: str | None = None, competition: str | None = None) -> DataFrame:
    """The ``k`` players with most xG + xA per 90 of each position; the slicers select rows before."""
    rows = m5
    for name, value in (("primary_position", position), ("competition_folder_name", competition)):
        rows = rows.where(col(name) == value) if value is not None else rows
    score = rnd(col("np_xg_per_90") + col("xa_per_90"), 2)
    w = Window.partitionBy("primary_position").orderBy(score.desc_nulls_last(), "player_id", "team_comp_key")
    return rows.withColumn("threat_per_90", score).withColumn("rank", F.row_number().over(w).cast("long")).where(
        col("rank") <= k).select("primary_position", "rank", "player_id", "player_name", "team_comp_key", "threat_per_90")


@query("players_by_position")
def q_players_by_position(spark, sf):
    return top_players(Tables(spark, sf).m5())


@query("players_sliced")
def q_players_sliced(spark, sf):
    return top_players(Tables(spark, sf).m5(), position="Center Forward", competition="comp_1")


@query("catalog_sample")
def q_catalog_sample(spark, sf):
    """The first five rows of every source table, found in the session's catalogue, as (table,
    place, row): the columns as text, long ones by their length and digest."""
    parts = []
    for name, keys in SAMPLE_KEYS.items():
        view = f"src_{name}"
        fbsrc.read_table(spark, sf, name).createOrReplaceTempView(view)
        rows = spark.table(view)
        five = rows.orderBy(*keys).limit(5)
        place = F.row_number().over(Window.orderBy(*keys))  # numbers five rows
        parts.append(five.withColumn("place", place.cast("long")).select(
            F.lit(name).alias("table_name"), "place", F.concat_ws("|", *[_shown(f) for f in rows.schema.fields]).alias("row")))
    return reduce(DataFrame.unionByName, parts)


#: The order in which each table's sample is taken.
SAMPLE_KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
               "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "events": ["event_id"], "documents": ["doc_id"],
               "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"]}


def _shown(field) -> F.Column:
    """A column as text that engines agree on: whole numbers, dates and short texts as they are, other
    numbers in thousandths, long or nested values by size."""
    c, kind = col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.ArrayType):
        text = F.concat(F.size(c).cast("string"), F.lit(" values"))
    elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        text = F.floor(c.cast("double") * 1000 + F.lit(0.5)).cast("string")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, T.StringType):
        text = F.when(F.length(c) <= 40, c).otherwise(F.concat(F.length(c).cast("string"), F.lit(" "), F.md5(c.cast("binary"))))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("null"))


@query("ml_export")
def q_ml_export(spark, sf):
    """The feature table written as Parquet and read back the way a model reads it."""
    path = f"{temporary_folder(spark, "exports")}/ml_dataset"
    features_of(Tables(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


@query("scaled_features")
def q_scaled_features(spark, sf):
    scaled = ml.scaled_features(features_of(Tables(spark, sf)))
    return scaled.select("team_comp_key", *[rnd(c, 5).alias(c) for c in scaled.columns[1:]])


@query("fold_sizes")
def q_fold_sizes(spark, sf):
    """The folds the models are validated on: rows of each class in each."""
    folds = ml.stratified_folds(features_of(Tables(spark, sf)))
    return folds.groupBy("fold", "outcome_class").agg(F.count(F.lit(1)).alias("teams"))


@query("check_symmetry_violation")
def q_check_symmetry_violation(spark, sf):
    """The symmetry check on a mart that is wrong by a known amount: five minutes are added to every
    winning spell of matches divisible by three, so exactly those with a winner must show up."""
    from pitchline.plans import gamestate as gs
    broken = Tables(spark, sf).m6().withColumn("minutes_in_state", F.when(
        (col("game_state") == "Winning") & (col("match_id") % 3 == 0), col("minutes_in_state") + 5.0).otherwise(col("minutes_in_state")))
    return gs.check_symmetry(broken).select("match_id")
