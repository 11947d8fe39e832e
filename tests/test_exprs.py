from pyspark.sql import functions as F

from pitchline.functions import exprs as X


def one(spark, expr, schema="x double", rows=((None,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expr).collect()]


def test_round_half_away_matches_binary_rounding(spark):
    # round_edges fixture: DuckDB rounds the binary value; plain Spark round(0.285, 2) gives 0.29
    rows = [(0.285,), (1.005,), (2.675,), (-2.5,)]
    assert one(spark, X.round_half_away("x", 2), rows=rows) == [0.28, 1.0, 2.68, -2.5]
    assert one(spark, X.round_half_away("x", 0), rows=rows) == [0.0, 1.0, 3.0, -3.0]


def test_ratio_is_null_safe_under_ansi(spark):
    rows = [(1, 0), (1, None), (3, 2)]
    assert one(spark, X.ratio("a", "b"), "a long, b long", rows) == [None, None, 1.5]


def test_array_at_short_arrays(spark):
    rows = [([],), ([1.0],), ([1.0, 2.0],), ([1.0, 2.0, 3.0],), (None,)]
    assert one(spark, X.array_at("a", 3), "a array<double>", rows) == [None, None, None, 3.0, None]
    assert one(spark, X.array_at("a", 1), "a array<double>", rows) == [None, 1.0, 1.0, 1.0, None]


def test_mmss_to_seconds(spark):
    rows = [("00:00",), ("05:30",), ("120:00",), (None,)]
    assert one(spark, X.mmss_to_seconds("s"), "s string", rows) == [0, 330, 7200, None]


def test_team_key_never_skips_null(spark):
    rows = [("A", "c", 2024), ("A", None, 2024)]
    assert one(spark, X.team_key("t", "c", "s"), "t string, c string, s int", rows) == ["A|c|2024", None]


def test_period_clock_conventions(spark):
    rows = [(1, 47, 0), (2, 0, 30), (4, 1, 0), (5, 0, 10)]
    sch = "period int, minute long, second long"
    assert one(spark, X.period_clock(), sch, rows) == [2820, 2730, 6360, None]
    assert one(spark, X.period_clock(convention="cumulative"), sch, rows) == [2820, 30, 60, 10]


def test_not_equal_drops_null_like_sql(spark):
    rows = [("Penalty",), ("Open Play",), (None,)]
    df = spark.createDataFrame(rows, "shot_type string")
    assert [r[0] for r in df.where(F.col("shot_type") != "Penalty").collect()] == ["Open Play"]
