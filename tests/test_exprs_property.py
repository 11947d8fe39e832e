"""Property tests: the Spark numeric helpers agree with DuckDB on generated inputs."""

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from pitchline.functions import exprs as X

values = st.one_of(
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False),
    st.integers(min_value=-10**6, max_value=10**6).map(lambda i: i / 1000.0),    # 3-decimal data
    st.integers(min_value=-10**5, max_value=10**5).map(lambda i: i / 200.0),     # exact halves
    st.integers(min_value=0, max_value=10**4).map(lambda i: i / 1024.0),         # xG-like
)


@settings(max_examples=25, deadline=None)
@given(xs=st.lists(values, min_size=1, max_size=60), n=st.integers(min_value=0, max_value=4))
def test_round_half_away_matches_duckdb(spark, xs, n):
    pdf = pd.DataFrame({"i": range(len(xs)), "x": xs})
    got = dict(spark.createDataFrame(pdf).select("i", X.round_half_away("x", n)).collect())
    con = duckdb.connect()
    con.register("t", pdf)
    want = dict(con.execute(f"select i, round(x, {n}) from t").fetchall())
    assert got == want


@settings(max_examples=15, deadline=None)
@given(pairs=st.lists(st.tuples(st.integers(-50, 50), st.integers(-3, 3)), min_size=1, max_size=40))
def test_ratio_matches_sql_nullif_division(spark, pairs):
    pdf = pd.DataFrame({"i": range(len(pairs)), "a": [p[0] for p in pairs], "b": [p[1] for p in pairs]})
    got = dict(spark.createDataFrame(pdf).select("i", X.round_half_away(X.ratio("a", "b"), 3)).collect())
    con = duckdb.connect()
    con.register("t", pdf)
    want = dict(con.execute("select i, round(a * 1.0 / nullif(b, 0), 3) from t").fetchall())
    assert got == want
