
from pyspark.sql import functions as F

from jornada import fixtures as fx
from jornada.config import Zone
from jornada.plans import curate_all, hydro_sales
from jornada.session import scratch_dir
from jornada.sources import scan_curated
from jornada.spec import CUSTOMERS, PROVIDERS, TRANSACTIONS

SF = "/root/testdata/sf0.01"


def test_sf001_curation_and_query(spark):
    root = scratch_dir(spark, "published")
    zone = Zone(raw_root=f"{root}/raw", curated_root=f"{root}/cur", env="published")
    day = fx.FLAGSHIP_DATE
    fx.stage_raw_day(fx.raw_transactions(spark, SF), zone, TRANSACTIONS, day)
    fx.stage_raw_day(fx.raw_providers(spark, SF), zone, PROVIDERS, day)
    fx.stage_raw_day(fx.raw_customers(spark, SF), zone, CUSTOMERS, day)
    results = curate_all(spark, day, zone)
    tx = results["Transactions"]
    assert tx.rows == 60_000
    assert tx.metrics["zero_filled_precio"] == 8_622
    assert tx.metrics["unparsed_precio"] == 0 and tx.metrics["unparsed_cantidad_comprada"] == 0
    assert results["Providers"].rows == 100 and results["Customers"].rows == 1_500
    curated = scan_curated(spark, tx.path, TRANSACTIONS)
    keys = curated.agg(F.countDistinct("primary_key").alias("d")).first().d
    assert keys == 60_000
    assert curated.where(F.col("precio") == 0).count() == 8_622
    q = hydro_sales(spark.table(tx.table))
    agg = q.agg(F.count(F.lit(1)).alias("n"), F.sum("Precio").alias("s")).first()
    assert (agg.n, agg.s) == (17_160, 913_913_522)
