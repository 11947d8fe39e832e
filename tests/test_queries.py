"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate),
plus the smoke entry, rows-only queries and partition-count invariance."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF0001, SF001
from pitchline.oracle import registry
from pitchline.plans import catalog
from pitchline.sources import fb as fbsrc

TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "array<double>": "DOUBLE[]", "date": "DATE", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP"}

# the corpus operators have their own tests
QUERIES = catalog.load_all()
ORACLE = registry.oracle_sql()
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _sort(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in fbsrc.TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert ROWS_ONLY == ["ml_cv", "ml_importance"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "team_comp_key" in df.columns


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF001)
    cols = sorted(df.columns)
    got = _sort([tuple(_norm(r[c]) for c in cols) for r in df.collect()])
    rel = duck.sql(ORACLE[key])
    ocols = rel.columns
    assert sorted(ocols) == cols
    # column types agree too (Spark simple type name -> DuckDB type name)
    spark_types = {f.name: TYPE_MAP.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == {n: str(t) for n, t in zip(rel.columns, rel.types)}
    idx = [ocols.index(c) for c in cols]
    want = _sort([tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()])
    assert got == want


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_queries_run(spark, key):
    rows = QUERIES[key](spark, SF001).collect()
    assert rows
    if key == "ml_cv":
        assert {r.model for r in rows} == {"logistic_regression", "random_forest"}
        assert all(0.0 <= r.mean_accuracy <= 1.0 for r in rows)


@pytest.mark.parametrize("mart", ["m1", "m3", "m6"])
def test_results_do_not_depend_on_partitioning(spark, mart):
    def run(n):
        t = catalog.Tables(spark, SF0001)
        t._ev = fbsrc.fb_events(t.raw("events").repartition(n))
        df = getattr(t, mart)()
        return _sort([tuple(_norm(x) for x in r) for r in df.collect()])
    assert run(1) == run(7)
