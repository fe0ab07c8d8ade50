"""A day holding half of all rows is spread over many tasks: splits of its raw
files become separate tasks and separate output files, with no shuffle."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from jornada import fixtures as fx
from jornada.config import Zone
from jornada.operators import curate_frame
from jornada.plans import curate_backfill
from jornada.session import scratch_dir
from jornada.sources import scan_curated, scan_raw_backfill
from jornada.spec import TRANSACTIONS
from test_plans import plan_of


def test_hot_day_spreads_over_tasks(spark):
    root = scratch_dir(spark, "skew")
    zone = Zone(raw_root=f"{root}/raw", curated_root=f"{root}/cur", env="skewtest")
    months = fx.monthly_transactions(spark, SF_SMALL)
    hot = (fx.raw_transactions(spark, SF_SMALL)
           .withColumns({"year": F.lit("2024"), "month": F.lit("01"), "day": F.lit("01")}))
    fx.stage_raw_zone(months.unionByName(hot), zone, TRANSACTIONS)
    total = months.count() * 2

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        raw = scan_raw_backfill(spark, zone, TRANSACTIONS)
        plan = plan_of(curate_frame(raw, TRANSACTIONS))
        assert "Exchange" not in plan
        result = curate_backfill(spark, TRANSACTIONS, zone, sync=False)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

    assert result.rows == total
    curated = scan_curated(spark, result.path, TRANSACTIONS)
    hot_files = (curated.where("year = '2024' AND month = '01' AND day = '01'")
                 .groupBy(F.col("_metadata.file_path")).count().collect())
    hot_rows = sum(r["count"] for r in hot_files)
    assert hot_rows == total // 2
    assert len(hot_files) >= 4
    assert max(r["count"] for r in hot_files) <= hot_rows // 3
