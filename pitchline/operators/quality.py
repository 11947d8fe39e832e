"""Declarative data-quality checks as Spark jobs.

``run_checks(tables, specs)`` returns one row per (table, check, column) with a failure count.
All not-null and accepted-values checks of a table are computed in ONE aggregation pass
(partial aggregation, one row out per task); uniqueness needs a ``groupBy`` on the column.
A check passes when ``failures == 0``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

col = F.col
RESULT_COLS = ["table_name", "check_name", "column_name", "failures"]


@dataclass
class TableChecks:
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted_values: dict[str, list] = field(default_factory=dict)


def _row_checks(spec: TableChecks) -> list[tuple]:
    """(check, column, condition of a failing row) of the checks that look at one row at a time."""
    checks = [("not_null", c, col(c).isNull()) for c in spec.not_null]
    # as the SQL original: NULL is neither accepted nor a failure here (not_null covers it)
    return checks + [("accepted_values", c, ~col(c).isin(*v)) for c, v in spec.accepted_values.items()]


def write_observed(table: str, df: DataFrame, spec: TableChecks, write) -> list[tuple[str, str, str | None, int]]:
    """Writes ``df`` (``write`` gets its writer) and returns what was observed of the rows on their way
    to the files: (table, 'rows', None, number of rows) and a row like ``run_checks`` for every not-null
    and accepted-values check. Nothing is read again; a task that is tried again counts once."""
    checks = _row_checks(spec)
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(bad).alias(f"f{i}") for i, (_, _, bad) in enumerate(checks)]]
    write(df.observe(seen, *metrics).write)
    found = seen.get
    return [(table, "rows", None, int(found["rows"])),
            *[(table, check, c, int(found[f"f{i}"])) for i, (check, c, _) in enumerate(checks)]]


def observed_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "table_name string, check_name string, column_name string, failures long")


def _one_pass(table: str, df: DataFrame, spec: TableChecks) -> DataFrame | None:
    exprs = _row_checks(spec)
    if not exprs:
        return None
    row = df.agg(*[F.count_if(bad).cast("long").alias(f"f{i}") for i, (_, _, bad) in enumerate(exprs)])
    # unpivot the single result row into one row per check
    entries = [F.struct(F.lit(chk).alias("check_name"), F.lit(c).alias("column_name"),
                        col(f"f{i}").alias("failures")) for i, (chk, c, _) in enumerate(exprs)]
    return (row.select(F.explode(F.array(*entries)).alias("e"))
            .select(F.lit(table).alias("table_name"), "e.check_name", "e.column_name", "e.failures"))


def _unique(table: str, df: DataFrame, c: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dups = df.where(col(c).isNotNull()).groupBy(c).count().where(col("count") > 1)
    return dups.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("check_name"),
        F.lit(c).alias("column_name"), "failures")


def run_checks(tables: dict[str, DataFrame], specs: dict[str, TableChecks]) -> DataFrame:
    """All checks of all tables as one DataFrame (table_name, check_name, column_name, failures)."""
    parts = []
    for name, spec in specs.items():
        df = tables[name]
        p = _one_pass(name, df, spec)
        if p is not None:
            parts.append(p)
        parts.extend(_unique(name, df, c) for c in spec.unique)
    return reduce(DataFrame.unionByName, parts)


def null_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: ``alias -> number of NULLs in column`` for each entry (one aggregation pass)."""
    return df.agg(*[F.count_if(col(c).isNull()).cast("long").alias(a) for a, c in columns.items()])


def tag_bad_records(df: DataFrame, rules: dict[str, object]) -> DataFrame:
    """Rows with ``reject_reason``, the first rule that is TRUE for the row, NULL for good rows."""
    reason = None
    for r, bad in rules.items():
        reason = F.when(bad, F.lit(r)) if reason is None else reason.when(bad, F.lit(r))
    return df.withColumn("reject_reason", reason)


def bad_record_split(df: DataFrame, rules: dict[str, object]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, quarantine). ``rules`` maps a reason to a Column that is TRUE when
    the row is bad. Quarantined rows carry ``reject_reason`` (the first failing rule) -- the
    per-record isolation of the original loader, for two sinks."""
    tagged = tag_bad_records(df, rules)
    return (tagged.where(col("reject_reason").isNull()).drop("reject_reason"),
            tagged.where(col("reject_reason").isNotNull()))
