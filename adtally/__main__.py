"""Command line: the reference workflow's commands as Spark jobs.

    python -m adtally list                                   # registered queries
    python -m adtally build --sf-dir DIR [--root PATH]       # staging + marts + tests + charts, written
    python -m adtally build --raw EVENTS PUBLISHERS CAMPAIGNS UNITS [--root PATH]   # the same over production tables
    python -m adtally test  --sf-dir DIR                     # the 35 data tests; exit 1 if any fails
    python -m adtally run NAME --sf-dir DIR [--out PATH] [--show N]

``run`` writes the full result as Parquet when ``--out`` is given, otherwise prints the first
``--show`` rows (a preview; nothing else is collected to the driver).
"""

from __future__ import annotations

import argparse
import sys

from adtally import catalog
from adtally.session import get_spark, size_for_input
from adtally.sources.registry import RAW_TABLES, from_tables


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="adtally")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("build", "test", "run"):
        p = sub.add_parser(name)
        where = p.add_mutually_exclusive_group(required=True)
        where.add_argument("--sf-dir", help="folder of test tables")
        if name == "build":
            where.add_argument("--raw", nargs=4, metavar=("EVENTS", "PUBLISHERS", "CAMPAIGNS", "UNITS"),
                               help="production raw tables (Parquet paths)")
        p.add_argument("--master", default=None)
        if name == "build":
            p.add_argument("--root", default=None)
        if name == "run":
            p.add_argument("query")
            p.add_argument("--out", default=None)
            p.add_argument("--show", type=int, default=20)
    args = ap.parse_args(argv)

    if args.cmd == "list":
        print("\n".join(catalog.CATALOG))
        return 0
    spark = get_spark(args.master)
    if args.cmd == "build":
        from adtally.plans import pipeline
        raw = None
        if args.raw:
            size_for_input(spark, args.raw)
            raw = from_tables(spark, dict(zip(RAW_TABLES, args.raw)))
        for name, path in pipeline.run_build(spark, args.sf_dir, root=args.root, raw=raw).items():
            print(f"{name}\t{path}")
        return 0
    if args.cmd == "test":
        results = catalog.run("data_test_results", spark, args.sf_dir)
        rows = results.orderBy("model", "column_name", "test").collect()  # 35 rows
        for r in rows:
            print(f"{'PASS' if r.passed else 'FAIL'}\t{r.model}.{r.column_name or '-'}\t{r.test}\t{r.failures}")
        failed = sum(not r.passed for r in rows)
        print(f"{len(rows) - failed} of {len(rows)} passed")
        return 1 if failed else 0
    if args.query not in catalog.CATALOG:
        print(f"unknown query {args.query}; see `python -m adtally list`", file=sys.stderr)
        return 2
    df = catalog.run(args.query, spark, args.sf_dir)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
        print(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
