"""pitchline: football event analytics as Spark DataFrame operators.

Layout
------
sources/    table loading: the football-shaped view over ``events``, bronze/silver shaping
functions/  column helpers (safe ratio, engine-stable rounding, per-90, clock parsing)
operators/  reusable relational and timeline operators, data-quality checks
plans/      the six marts, serving extracts, outcome labels, ML
streaming/  incremental landing of new matches with Structured Streaming
oracle/     DuckDB SQL used as an independent correctness oracle
"""

__all__ = ["session"]
