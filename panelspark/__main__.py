"""Command line.

``python -m panelspark ingest --source a|b|c --landing DIR --raw DIR`` loads a provider's landed files into its raw
table; ``python -m panelspark run --raw DIR --out DIR [--as-of DATE] [--no-gate]`` builds the marts.

``--raw`` holds the three raw tables as Parquet directories ``iso``,
``mixed`` and ``periods``; ``--derive SF_DIR`` instead derives them from the
driver tables and writes them under ``--out/raw`` first.
"""

from __future__ import annotations

import argparse
import json
import re
import sys

from .plans import ingest, pipeline
from .session import local_session
from .sources import derived, tables


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="panelspark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="stage → marts → quality gate")
    src = run.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="directory with raw tables iso/, mixed/, periods/")
    src.add_argument("--derive", help="driver table directory to derive raw tables from")
    run.add_argument("--out", required=True)
    run.add_argument("--as-of", default=None)
    run.add_argument("--no-gate", action="store_true")
    load = sub.add_parser("ingest", help="landed files → raw table, new rows only")
    load.add_argument("--source", required=True, choices=sorted(ingest.TABLES))
    load.add_argument("--landing", required=True, help="folder or glob of landed files")
    load.add_argument("--raw", required=True, help="directory of the raw tables")
    for cmd in (run, load):
        cmd.add_argument("--master", default=None, help="local or local[N] for a local run; omit under spark-submit")
    args = ap.parse_args(argv)

    if args.master:
        cores = re.fullmatch(r"local(?:\[(.+)\])?", args.master)
        if not cores:
            ap.error(f"--master {args.master}: only local or local[N]; give other masters to spark-submit")
        spark = local_session(cores[1] or "1")
    else:
        from pyspark.sql import SparkSession

        from .session import configure, ensure_checkpoint_dir

        spark = configure(SparkSession.builder.getOrCreate())
        ensure_checkpoint_dir(spark)

    if args.cmd == "ingest":
        try:
            done = ingest.ingest(spark, args.source, args.landing, args.raw)
        except Exception as e:
            print(json.dumps({"status": "failed", "error": str(e)[:2000]}))
            return 1
        print(json.dumps({"status": "ok", **done.__dict__}))
        return 0

    raw_dir = args.raw
    if args.derive:
        raw_dir = f"{args.out.rstrip('/')}/raw"
        for name, df in derived.raw_tables(spark, args.derive, stage=True).items():
            tables.materialize(df, f"{raw_dir}/{name}")
    try:
        res = pipeline.run(spark, pipeline.read_raw_tables(spark, raw_dir), args.out, as_of=args.as_of,
                           gate=not args.no_gate)
    except Exception as e:  # the gate's error lists the failing checks
        print(json.dumps({"status": "failed", "error": str(e)}))
        return 1
    print(json.dumps({"status": "ok", "time_series": res.time_series_path, "overview": res.overview_path,
                      "report": res.report}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
