"""Command line for scheduled runs: ``python -m jornada <job> [options]``.

Jobs:

* ``curate``  one dataset (or all) for one process date;
* ``backfill`` one dataset (or all) for a date range, from either raw layout;
* ``land``    a drop folder, optionally only the objects of one date;
* ``query``   the saved hydro-sales query over a curated table, written out.

Locations default to the bucket naming rule (``--account``, ``--env``,
``--scheme``); ``--raw-root`` / ``--curated-root`` override them. A process
date that is not ``yyyyMMdd`` ends the run with exit code 1. The Spark
session is whatever the launcher provides (``SparkSession.builder.getOrCreate``).
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from .config import BatchDate, Zone, normalize_env
from .spec import DATASETS, spec_for


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m jornada")
    p.add_argument("job", choices=("curate", "backfill", "land", "query"))
    p.add_argument("--start", help="first date of a backfill, yyyyMMdd (default: the first there is)")
    p.add_argument("--end", help="last date of a backfill, yyyyMMdd (default: the last there is)")
    p.add_argument("--process-date", help="yyyyMMdd")
    p.add_argument("--dataset", default="all",
                   help=f"one of {sorted(DATASETS)} or 'all' (curate)")
    p.add_argument("--account", default="")
    p.add_argument("--env", default="pdn", help="qa is written qc in every name")
    p.add_argument("--scheme", default="s3a")
    p.add_argument("--raw-root")
    p.add_argument("--curated-root")
    p.add_argument("--raw-layout", default="folders", choices=("folders", "files"),
                   help="raw zone of day folders, or one file per dataset and day under "
                        "<Dataset>/yyyy/MM/dd (curate, backfill)")
    p.add_argument("--type-process", default="INC", help="accepted for compatibility; unused")
    p.add_argument("--rerun", default="append", choices=("append", "replace"))
    p.add_argument("--format", default="parquet")
    p.add_argument("--drop", help="drop folder (land)")
    p.add_argument("--output", help="folder for the query result (query)")
    return p


def _zone(args) -> Zone:
    named = Zone.named(args.account, args.env, args.scheme)
    return Zone(raw_root=args.raw_root or named.raw_root,
                curated_root=args.curated_root or named.curated_root,
                env=normalize_env(args.env))


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    batch = None
    start = end = None
    if args.process_date is not None or args.job in ("curate", "backfill"):
        try:
            batch = BatchDate(args.process_date or "") if args.job != "backfill" else None
            start, end = (BatchDate(d) if d else None for d in (args.start, args.end))
        except ValueError as exc:
            print(f"error: {exc}", file=sys.stderr)
            return 1

    from pyspark.sql import SparkSession

    from .plans import curate, curate_all, curate_backfill, hydro_sales_sql, land_drop

    spark = SparkSession.builder.getOrCreate()
    zone = _zone(args)
    if args.job == "curate":
        if args.dataset == "all":
            results = curate_all(spark, batch, zone, raise_errors=False, rerun=args.rerun,
                                 fmt=args.format, per_file=args.raw_layout == "files")
        else:
            r = curate(spark, spec_for(args.dataset), batch, zone, rerun=args.rerun,
                       fmt=args.format, per_file=args.raw_layout == "files")
            results = {r.dataset: r}
        print(json.dumps({k: ({"error": str(v).splitlines()[0]} if isinstance(v, Exception)
                              else {"rows": v.rows, "table": v.table, **v.metrics})
                          for k, v in results.items()}))
        if any(isinstance(v, Exception) for v in results.values()):
            return 1
    elif args.job == "backfill":
        specs = list(DATASETS.values()) if args.dataset == "all" else [spec_for(args.dataset)]
        done = {s.name: curate_backfill(spark, s, zone, start, end, fmt=args.format, rerun=args.rerun,
                                        per_file=args.raw_layout == "files") for s in specs}
        print(json.dumps({k: {"rows": r.rows, "table": r.table, **r.metrics} for k, r in done.items()}))
    elif args.job == "land":
        if not args.drop:
            print("error: --drop is required for land", file=sys.stderr)
            return 2
        report = land_drop(spark, args.drop, zone, batch)
        counts = {r.status: r["count"] for r in report.groupBy("status").count().collect()}
        print(json.dumps(counts))
    else:
        if not args.output:
            print("error: --output is required for query", file=sys.stderr)
            return 2
        table = zone.table_name(spec_for("Transactions"))
        hydro_sales_sql(spark, table).write.mode("overwrite").parquet(args.output)
        print(json.dumps({"table": table, "output": args.output}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
