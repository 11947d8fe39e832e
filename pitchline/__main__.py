"""Command line: list, run or explain a registered query, or build an input's tables.

    python -m pitchline list
    python -m pitchline run mart_gamestate --sf /root/testdata/sf0.1 --show 20
    python -m pitchline run mart_gamestate --sf /root/testdata/sf0.1 --explain
    python -m pitchline build --sf /root/testdata/sf0.1        # Silver tables and marts
    python -m pitchline export --sf DIR --out OUT               # the six marts as Parquet

``--master`` defaults to ``local[*]``; on a cluster pass ``--master ''`` to use the launcher's.
"""

from __future__ import annotations

import argparse
import sys
import time


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="pitchline")
    ap.add_argument("command", choices=["list", "run", "build", "export"])
    ap.add_argument("key", nargs="?")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--explain", action="store_true")
    ap.add_argument("--out")
    ap.add_argument("--master", default="local[*]")
    a = ap.parse_args(argv)

    from pitchline.plans.catalog import load_all
    queries = load_all()
    if a.command == "list":
        from pitchline.oracle.registry import oracle_sql
        checked = oracle_sql()
        for k in sorted(queries):
            print(f"{k:30s} {'oracle' if k in checked else 'rows-only'}")
        return 0

    from pitchline.session import build_session
    spark = build_session(a.master or None, app_name=f"pitchline-{a.command}")
    if a.command == "run":
        if a.key not in queries:
            print(f"unknown query {a.key!r}; see `python -m pitchline list`", file=sys.stderr)
            return 2
        df = queries[a.key](spark, a.sf)
        if a.explain:
            df.explain("formatted")
        else:
            t0 = time.perf_counter()
            df.show(a.show, truncate=False)
            print(f"{a.key}: {time.perf_counter() - t0:.2f}s")
    elif a.command == "build":
        from pitchline.plans.catalog import Tables
        from pitchline.sources.warehouse import materialise
        t0 = time.perf_counter()
        root = materialise(spark, a.sf)
        Tables(spark, a.sf).marts()
        print(f"built {root} in {time.perf_counter() - t0:.1f}s")
    elif a.command == "export":
        if not a.out:
            print("--out is required", file=sys.stderr)
            return 2
        from pitchline.plans.catalog import Tables
        from pitchline.plans.queries_serving import EXPORT_NAMES
        for k, df in Tables(spark, a.sf).marts().items():
            df.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{EXPORT_NAMES[k]}.parquet")
            print("exported", EXPORT_NAMES[k])
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
