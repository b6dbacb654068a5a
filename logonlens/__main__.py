"""Command line: ``python -m logonlens --root ROOT [--raw-auth ...] [--raw-redteam ...]
[--skip-bronze] [--only-load] [--jdbc-url URL]`` runs the medallion pipeline in the
session ``spark-submit`` (or the environment) provides and prints the run report."""

from __future__ import annotations

import argparse
import json
import sys


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="logonlens", description="bronze -> silver -> gold (-> JDBC load)")
    p.add_argument("--root", required=True, help="lake root holding bronze/, silver/, gold/")
    p.add_argument("--raw-auth", nargs="+", help="raw auth log file(s) or directory")
    p.add_argument("--raw-redteam", nargs="+", help="raw red-team log file(s) or directory")
    p.add_argument("--skip-bronze", action="store_true", help="reuse the existing bronze tables")
    p.add_argument("--only-load", action="store_true", help="only load the existing gold tables")
    p.add_argument("--jdbc-url", help="load the gold tables to this JDBC database")
    p.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE",
                   help="extra JDBC option (user, password, driver, ...); repeatable")
    scans = p.add_mutually_exclusive_group()
    scans.add_argument("--direct-scans", action="store_true",
                       help="one aggregate per silver table (the default)")
    scans.add_argument("--cube", action="store_true", help="silver tables as rollups of one written cube")
    p.add_argument("--missing-values", action="store_true",
                   help="read NA, NaN, null and the like in the raw logs as missing")
    p.add_argument("--fail-on-bad-lines", action="store_true",
                   help="stop at the first malformed line (default: write such lines to a rejects partition)")
    p.add_argument("--input-bytes", type=int, help="uncompressed bytes of the raw log, for the session's sizing")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    from pyspark.sql import SparkSession

    from logonlens.plans.medallion import run_medallion
    from logonlens.session import scale_conf

    builder = SparkSession.builder.appName("logonlens")
    if args.input_bytes:
        builder = builder.config(map=scale_conf(args.input_bytes))
    spark = builder.getOrCreate()
    report = run_medallion(
        spark, args.root, raw_auth=args.raw_auth, raw_redteam=args.raw_redteam,
        skip_bronze=args.skip_bronze, only_load=args.only_load, jdbc_url=args.jdbc_url,
        jdbc_properties=dict(opt.split("=", 1) for opt in args.jdbc_option) or None,
        shared_scan=args.cube, pandas_nulls=args.missing_values,
        **({"on_bad_lines": "fail"} if args.fail_on_bad_lines else {}),
    )
    print(json.dumps(report, indent=2, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
