"""Command line: list, sql, explain, run and check the library's queries.

    python -m cairnwork list [PART]              names of queries
    python -m cairnwork sql NAME                 its DuckDB SQL
    python -m cairnwork explain NAME SF_DIR      its plan
    python -m cairnwork run NAME SF_DIR [--out PATH] [--replace] [--rows N]
                                                 print rows, or publish the whole result
    python -m cairnwork count SF_DIR NAME ...    rows and seconds of each
    python -m cairnwork checks SF_DIR            quality checks; exit code 1 if one fails
"""

from __future__ import annotations

import argparse
import sys
import time

CHECKS = ("qc_suite", "strict_checks", "tag_table_checks")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cairnwork", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list").add_argument("part", nargs="?", default="")
    sub.add_parser("sql").add_argument("name")
    explain, run, count, checks = (sub.add_parser(c) for c in ("explain", "run", "count", "checks"))
    for c in (explain, run):
        c.add_argument("name")
        c.add_argument("sf_dir")
    run.add_argument("--out")
    run.add_argument("--replace", action="store_true")
    run.add_argument("--rows", type=int, default=20)
    count.add_argument("sf_dir")
    count.add_argument("names", nargs="+")
    checks.add_argument("sf_dir")
    return p


def main(argv: list[str] | None = None) -> int:
    from cairnwork.plans.catalogue import QUERIES, SQL

    args = _parser().parse_args(argv)
    if args.command == "list":
        print("\n".join(sorted(n for n in QUERIES if args.part in n)))
        return 0
    unknown = [n for n in [*([args.name] if hasattr(args, "name") else []), *getattr(args, "names", [])] if n not in QUERIES]
    if unknown:
        print(f"no such query: {', '.join(unknown)}", file=sys.stderr)
        return 2
    if args.command == "sql":
        print(SQL.get(args.name, "SQL cannot express this query."))
        return 0
    from pyspark.sql import SparkSession

    from cairnwork.sources import sinks

    spark = SparkSession.builder.appName("cairnwork").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "explain":
        QUERIES[args.name](spark, args.sf_dir).explain("formatted")
    elif args.command == "run":
        df = QUERIES[args.name](spark, args.sf_dir)
        if args.out:
            sinks.publish(df, args.out, replace=args.replace)
        else:
            df.show(args.rows, truncate=False)
    elif args.command == "count":
        for n in args.names:
            began = time.time()
            print(n, QUERIES[n](spark, args.sf_dir).count(), round(time.time() - began, 2))
    else:
        bad = 0
        for n in CHECKS:
            for r in QUERIES[n](spark, args.sf_dir).collect():
                bad += r["status"] == "FAIL"
                print(n, *r)
        return int(bad > 0)
    return 0


if __name__ == "__main__":
    sys.exit(main())
