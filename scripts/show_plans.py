"""Write PLANS.md: formatted physical plans of the headline jobs and queries.

usage: python scripts/show_plans.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from jornada import registry as R  # noqa: E402
from jornada.functions.casting import _EDGE_CHARS  # noqa: E402
from jornada.operators import curate_frame  # noqa: E402
from jornada.operators.landing import landing_report  # noqa: E402
from jornada.sinks import clustered  # noqa: E402
from jornada.sources import scan_raw_backfill, scan_raw_day  # noqa: E402
from jornada.spec import TRANSACTIONS  # noqa: E402
from jornada.testing import local_session  # noqa: E402


def formatted(df) -> str:
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(),
                                                             "formatted")
    # The int cast trims U+0000..U+0020; print that literal readably.
    text = text.replace(_EDGE_CHARS, "\\x00-\\x20")
    # Scratch folders differ per run; keep the plan text stable.
    return re.sub(r"file:\S*/jornada/", "…/", text)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    day_zone = R.raw_day_zone(spark, sf_dir)
    back_zone = R.backfill_zone(spark, sf_dir)
    sections = [
        ("Saved query over the catalog table (Q1)",
         "Filters and the 5-column projection reach the parquet scan; one codegen stage.",
         R.q_query_hydro_sales(spark, sf_dir)),
        ("Saved query for one day",
         "The date predicate becomes PartitionFilters: other date folders are not read.",
         R.q_query_hydro_sales_day(spark, sf_dir)),
        ("Curation of one day, as written (J3)",
         "Scan, projections and the clustering sort; no Exchange.",
         clustered(curate_frame(scan_raw_day(spark, day_zone, TRANSACTIONS, R.DAY),
                                TRANSACTIONS, R.DAY), TRANSACTIONS)),
        ("Backfill curation, as written",
         "One per-task Sort (date columns first, as the partitioned writer needs); no Exchange.",
         clustered(curate_frame(scan_raw_backfill(spark, back_zone, TRANSACTIONS),
                                TRANSACTIONS), TRANSACTIONS)),
        ("Landing report",
         "Listing and line scan are aggregated map-side before the only shuffles, "
         "which carry one row per (file, field count).",
         landing_report(spark, R.drop_folder(spark, sf_dir))),
    ]
    out = ["# Physical plans", "",
           f"Generated by `scripts/show_plans.py` at `{sf_dir}` (Spark {spark.version}).", ""]
    for title, note, df in sections:
        out += [f"## {title}", "", note, "", "```", formatted(df).strip(), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
