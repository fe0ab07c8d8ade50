"""Benchmark: the curation jobs and the saved query at one scale factor.

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
Each entry is the median wall time of 3 runs after one warm-up. Jobs re-run
with ``rerun="replace"`` so every run does the same work; queries are forced
through the ``noop`` sink so every row is produced without a driver collect.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jornada import fixtures as fx  # noqa: E402
from jornada import registry as R  # noqa: E402
from jornada.config import BatchDate, Zone  # noqa: E402
from jornada.plans import curate, curate_backfill, hydro_sales, hydro_sales_sql, land_drop  # noqa: E402
from jornada.sources import scan_curated  # noqa: E402
from jornada.spec import CUSTOMERS, PROVIDERS, TRANSACTIONS  # noqa: E402
from jornada.streaming import curate_stream  # noqa: E402
from jornada.testing import local_session  # noqa: E402


ERRORS: dict[str, str] = {}


def timed(fn, repeat: int, name: str = "") -> float | None:
    """Median seconds of ``repeat`` runs after a warm-up; None if the job fails."""
    try:
        fn()  # warm-up
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
    except Exception as exc:  # noqa: BLE001 - report, keep the other timings
        ERRORS[name or getattr(fn, "__name__", "job")] = repr(exc)[:300]
        return None
    return round(statistics.median(runs), 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="jornada-bench")

    t0 = time.perf_counter()
    day_zone = R.raw_day_zone(spark, sf_dir)
    backfill_zone = R.backfill_zone(spark, sf_dir)
    drop = R.drop_folder(spark, sf_dir)
    _, tx = R.curated_day(spark, sf_dir, TRANSACTIONS)
    _, months = R.curated_months(spark, sf_dir)
    stage_sec = round(time.perf_counter() - t0, 3)
    day = fx.FLAGSHIP_DATE

    def stream_once():
        fresh = R._zone(spark, "bench-stream")
        target = Zone(backfill_zone.raw_root, fresh.curated_root, fresh.env)
        curate_stream(spark, TRANSACTIONS, target, sync=False).awaitTermination()

    jobs = {
        "curate_transactions":
            lambda: curate(spark, TRANSACTIONS, day, day_zone, rerun="replace"),
        "curate_providers": lambda: curate(spark, PROVIDERS, day, day_zone, rerun="replace"),
        "curate_customers": lambda: curate(spark, CUSTOMERS, day, day_zone, rerun="replace"),
        "query_hydro_sales": lambda: drain(hydro_sales_sql(spark, tx.table)),
        "query_hydro_sales_day":
            lambda: drain(hydro_sales(scan_curated(spark, months.path, TRANSACTIONS),
                                      day=BatchDate("19980601"))),
        "curate_backfill":
            lambda: curate_backfill(spark, TRANSACTIONS, backfill_zone, rerun="replace"),
        "curate_stream": stream_once,
        "landing": lambda: land_drop(spark, drop, R._zone(spark, "bench-landed")),
    }
    q = {name: timed(fn, repeat, name) for name, fn in jobs.items()}

    raw_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(v for v in q.values() if v is not None), 3),
        "unit": "sec",
        "queries": q,
        "sf": sf,
        "cpus": cpus,
        "spark": spark.version,
        "transactions_rows": raw_rows,
        "staging_sec": stage_sec,
        **({"errors": ERRORS} if ERRORS else {}),
    }))


if __name__ == "__main__":
    main()
