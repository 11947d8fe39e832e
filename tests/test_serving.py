"""Serving helpers: NULL order and tie-breaks in top-k lists (T5), position groups, exact means."""

from pyspark.sql import functions as F

from pitchline.functions.exprs import exact_mean
from pitchline.plans import serving


def test_top_k_nulls_last_and_ties(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("n", None), ("c", 1.0)], "team_comp_key string, v double")
    asc = serving.top_k(df, [F.col("v").asc_nulls_last(), F.col("team_comp_key")], 4, "x", F.col("v"),
                        ["team_comp_key"]).collect()
    desc = serving.top_k(df, [F.col("v").desc_nulls_last(), F.col("team_comp_key")], 4, "x", F.col("v"),
                         ["team_comp_key"]).collect()
    assert [(r["rank"], r.team_comp_key) for r in asc] == [(1, "c"), (2, "a"), (3, "b"), (4, "n")]
    assert [(r["rank"], r.team_comp_key) for r in desc] == [(1, "a"), (2, "b"), (3, "c"), (4, "n")]


def test_position_groups(spark):
    pos = ["Goalkeeper", "Left Center Back", "Right Back", "Left Wing Back", "Center Defensive Midfield",
           "Center Attacking Midfield", "Left Midfield", "Right Center Midfield", "Right Wing",
           "Center Forward", None]
    df = spark.createDataFrame([(p,) for p in pos], "p string")
    got = [r[0] for r in df.select(serving.position_group(F.col("p"))).collect()]
    assert got == ["Goalkeeper", "Center Back", "Fullback", "Fullback", "Defensive Mid", "Attacking Mid",
                   "Winger", "Central Mid", "Winger", "Forward", None]


def test_exact_mean_is_order_independent(spark):
    vals = [0.57, 0.64, 0.79, 0.61, 0.55, 0.64, 0.58, 0.63] * 3
    a = spark.createDataFrame([(v,) for v in vals], "x double").agg(exact_mean("x")).first()[0]
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").repartition(5) \
        .agg(exact_mean("x")).first()[0]
    assert a == b == round(sum(round(v * 100) for v in vals) / len(vals) / 100, 12)
