"""Registered queries: one per operator of the inventory, each with its oracle.

Every query reads the shared test tables of ``sf_dir`` (or files Spark derived
from them) and runs the library's operators on all of it. Files go to fresh
folders under the session's ``spark.checkpoint.dir``. Staged inputs are built
once per Spark application and shared by the queries that need them.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .config import BatchDate, Zone
from .operators.landing import scan_quarantine
from .operators import (add_partition_columns, cast_columns, fill_zero, landing_report,
                        list_drop, route, row_key, upper_column)
from .operators.filters import all_of, energy_is, kind_is, price_above
from .plans import curate, curate_backfill, hydro_sales, hydro_sales_sql, land_drop
from .session import app_id, scratch_dir
from .sources import scan_curated, scan_legacy_backfill, scan_raw, scan_raw_backfill
from .streaming import curate_stream
from .spec import CUSTOMERS, DATASETS, KEY_COLUMN, PARTITION_COLUMNS, PROVIDERS, TRANSACTIONS

DAY = fx.FLAGSHIP_DATE
MONTH_QUERIED = BatchDate("19980601")

_lock = threading.RLock()
_staged: dict = {}


def _once(spark: SparkSession, sf_dir: str, what: str, build: Callable):
    key = (app_id(spark), sf_dir, what)
    with _lock:
        if key not in _staged:
            _staged[key] = build()
        return _staged[key]


def _zone(spark: SparkSession, label: str, sf_dir: str | None = None,
          env: str | None = None) -> Zone:
    """A fresh zone. Its environment (hence catalog database) is ``env`` or
    ``label``, tagged with the scale, so one application can stage several
    scales without two of them claiming the same catalog table."""
    root = scratch_dir(spark, label)
    tag = re.sub(r"[^a-z0-9]", "", sf_dir.rstrip("/").rsplit("/", 1)[-1].lower()) if sf_dir else ""
    name = env or label
    return Zone(raw_root=f"{root}/raw", curated_root=f"{root}/curated",
                env=f"{name}_{tag}" if tag else name)


# ---- staged inputs -------------------------------------------------------------

def raw_day_zone(spark: SparkSession, sf_dir: str) -> Zone:
    """Raw zone holding one day (2023-12-04) of each of the three datasets."""
    def build():
        zone = _zone(spark, "day", sf_dir, env="pdn")
        fx.stage_raw_day(fx.raw_transactions(spark, sf_dir), zone, TRANSACTIONS, DAY)
        fx.stage_raw_day(fx.raw_providers(spark, sf_dir), zone, PROVIDERS, DAY)
        fx.stage_raw_day(fx.raw_customers(spark, sf_dir), zone, CUSTOMERS, DAY)
        return zone
    return _once(spark, sf_dir, "raw_day", build)


def curated_day(spark: SparkSession, sf_dir: str, spec=TRANSACTIONS):
    """The one-day raw zone curated into catalog tables (one per dataset)."""
    def build():
        zone = raw_day_zone(spark, sf_dir)
        return zone, curate(spark, spec, DAY, zone)
    return _once(spark, sf_dir, f"curated_day_{spec.name}", build)


def backfill_zone(spark: SparkSession, sf_dir: str) -> Zone:
    """Raw zone of event-dated transactions: one folder per day, one write."""
    def build():
        zone = _zone(spark, "backfill", sf_dir)
        fx.stage_raw_zone(fx.dated_transactions(spark, sf_dir), zone, TRANSACTIONS)
        return zone
    return _once(spark, sf_dir, "backfill", build)


def curated_backfill(spark: SparkSession, sf_dir: str):
    def build():
        zone = backfill_zone(spark, sf_dir)
        return zone, curate_backfill(spark, TRANSACTIONS, zone)
    return _once(spark, sf_dir, "curated_backfill", build)


def curated_months(spark: SparkSession, sf_dir: str):
    """Line-item transactions landed by ship month and curated in one job."""
    def build():
        zone = _zone(spark, "monthly", sf_dir)
        fx.stage_raw_zone(fx.monthly_transactions(spark, sf_dir), zone, TRANSACTIONS)
        return zone, curate_backfill(spark, TRANSACTIONS, zone, sync=False)
    return _once(spark, sf_dir, "curated_months", build)


def drop_folder(spark: SparkSession, sf_dir: str) -> str:
    def build():
        drop = f"{scratch_dir(spark, 'landing')}/drop"
        fx.stage_drop(spark, sf_dir, drop)
        return drop
    return _once(spark, sf_dir, "drop", build)


def landed(spark: SparkSession, sf_dir: str):
    def build():
        zone = _zone(spark, "landed", sf_dir)
        report = land_drop(spark, drop_folder(spark, sf_dir), zone)
        return zone, report
    return _once(spark, sf_dir, "landed", build)


# ---- queries -------------------------------------------------------------------

def _raw(spark, sf_dir, spec):
    return scan_raw(spark, raw_day_zone(spark, sf_dir).raw_day_path(spec, DAY))


def q_scan_raw_csv(spark, sf_dir):
    return _raw(spark, sf_dir, TRANSACTIONS)


def q_scan_raw_backfill(spark, sf_dir):
    return scan_raw_backfill(spark, backfill_zone(spark, sf_dir), TRANSACTIONS)


def legacy_zone(spark: SparkSession, sf_dir: str) -> Zone:
    """Raw zone in the per-file layout, one file per event day."""
    def build():
        zone = _zone(spark, "legacy", sf_dir)
        fx.stage_legacy_days(fx.dated_transactions(spark, sf_dir), zone.raw_root, TRANSACTIONS)
        return zone
    return _once(spark, sf_dir, "legacy", build)


def q_scan_raw_legacy_backfill(spark, sf_dir):
    return scan_legacy_backfill(spark, legacy_zone(spark, sf_dir).raw_root, TRANSACTIONS)


def q_cast_providers(spark, sf_dir):
    return cast_columns(_raw(spark, sf_dir, PROVIDERS), PROVIDERS)


def q_cast_customers(spark, sf_dir):
    return cast_columns(_raw(spark, sf_dir, CUSTOMERS), CUSTOMERS)


def q_cast_transactions(spark, sf_dir):
    return cast_columns(_raw(spark, sf_dir, TRANSACTIONS), TRANSACTIONS)


def q_upper_name(spark, sf_dir):
    return upper_column(_raw(spark, sf_dir, TRANSACTIONS), "nombre")


def q_fill_null_zero(spark, sf_dir):
    return fill_zero(q_cast_transactions(spark, sf_dir), "precio")


def q_partition_columns(spark, sf_dir):
    return add_partition_columns(_raw(spark, sf_dir, TRANSACTIONS), DAY)


def _curated(spark, sf_dir, spec):
    zone, result = curated_day(spark, sf_dir, spec)
    return scan_curated(spark, result.path, spec)


def q_surrogate_key(spark, sf_dir):
    df = _curated(spark, sf_dir, TRANSACTIONS)
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count(KEY_COLUMN).alias("n_keys"),
                  F.countDistinct(KEY_COLUMN).alias("n_distinct_keys"),
                  F.min(KEY_COLUMN).alias("min_key"))


def q_row_key(spark, sf_dir):
    """Repeatable content key over the natural columns of the curated rows."""
    df = _curated(spark, sf_dir, TRANSACTIONS)
    return df.select(*TRANSACTIONS.columns, row_key(TRANSACTIONS.columns).alias("row_key"))


def q_curate_providers(spark, sf_dir):
    return _curated(spark, sf_dir, PROVIDERS).drop(KEY_COLUMN)


def q_curate_customers(spark, sf_dir):
    return _curated(spark, sf_dir, CUSTOMERS).drop(KEY_COLUMN)


def q_curate_transactions(spark, sf_dir):
    return _curated(spark, sf_dir, TRANSACTIONS).drop(KEY_COLUMN)


def q_filter_equality(spark, sf_dir):
    df = q_curate_transactions(spark, sf_dir)
    return df.where(all_of(energy_is("hidroelectrica"), kind_is("venta")))


def q_filter_range(spark, sf_dir):
    return q_curate_transactions(spark, sf_dir).where(price_above(1000))


def q_query_hydro_sales(spark, sf_dir):
    zone, result = curated_day(spark, sf_dir, TRANSACTIONS)
    return hydro_sales_sql(spark, result.table)


def q_query_hydro_sales_day(spark, sf_dir):
    zone, result = curated_months(spark, sf_dir)
    day = scan_curated(spark, result.path, TRANSACTIONS, days=[MONTH_QUERIED])
    return hydro_sales(day, day=MONTH_QUERIED)


def q_partitioned_write(spark, sf_dir):
    zone, result = curated_backfill(spark, sf_dir)
    return scan_curated(spark, result.path, TRANSACTIONS).drop(KEY_COLUMN)


def _day_counts(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias(name))


def q_append_batch(spark, sf_dir):
    """Rows per date after one append, a second append, and a replace.

    Each snapshot of counts is written as a small table before the next run
    changes the data, then the three are joined on the date.
    """
    zone = backfill_zone(spark, sf_dir)
    target = _zone(spark, "append", sf_dir)
    target = Zone(zone.raw_root, target.curated_root, zone.env)
    snaps = scratch_dir(spark, "append-counts")
    names = ("rows_after_first", "rows_after_second", "rows_after_replace")
    for name, rerun in zip(names, ("append", "append", "replace")):
        curate_backfill(spark, TRANSACTIONS, target, rerun=rerun, sync=False)
        counts = _day_counts(scan_curated(spark, target.curated_path(TRANSACTIONS), TRANSACTIONS),
                             name)
        counts.write.parquet(f"{snaps}/{name}")
    out = None
    for name in names:
        part = spark.read.parquet(f"{snaps}/{name}")
        out = part if out is None else out.join(part, list(PARTITION_COLUMNS), "full")
    return out


def q_catalog_sync(spark, sf_dir):
    zone, result = curated_backfill(spark, sf_dir)
    return spark.sql(f"SHOW PARTITIONS {result.table}")


def q_empty_batch(spark, sf_dir):
    """Curate a day with no raw rows (the day after the last event day)."""
    zone, result = curated_backfill(spark, sf_dir)
    # Its own raw zone: later queries of the run must not see the empty day.
    zone = Zone(_zone(spark, "empty", sf_dir).raw_root, zone.curated_root, zone.env)
    before = result.rows
    last = (fx.dated_transactions(spark, sf_dir)
            .agg(F.max(F.concat(*PARTITION_COLUMNS)).alias("d")).first().d)
    empty_day = BatchDate(_next_day(last))
    raw = fx.dated_transactions(spark, sf_dir).where(
        F.concat(*PARTITION_COLUMNS) == F.lit(empty_day.text))
    fx.stage_raw_day(raw.select(*TRANSACTIONS.columns), zone, TRANSACTIONS, empty_day)
    run = curate(spark, TRANSACTIONS, empty_day, zone, sync=False)
    after = scan_curated(spark, result.path, TRANSACTIONS)
    return after.agg(F.lit(before).cast("long").alias("rows_before"),
                     F.count(F.lit(1)).alias("rows_after"),
                     F.lit(run.rows).cast("long").alias("rows_in_batch"))


def _next_day(text: str) -> str:
    import datetime as dt
    return (dt.datetime.strptime(text, "%Y%m%d") + dt.timedelta(days=1)).strftime("%Y%m%d")


def q_curate_incremental(spark, sf_dir):
    """Land the first half of the days, run the stream, land the rest, run it again."""
    zone = _zone(spark, "incremental", sf_dir)
    dated = fx.dated_transactions(spark, sf_dir)
    day = F.concat(*PARTITION_COLUMNS)
    middle = dated.agg(F.percentile_approx(day.cast("int"), 0.5).alias("m")).first().m
    for part in (dated.where(day.cast("int") <= middle), dated.where(day.cast("int") > middle)):
        stage_landed_days(part, zone)
        curate_stream(spark, TRANSACTIONS, zone).awaitTermination()
    return scan_curated(spark, zone.curated_path(TRANSACTIONS), TRANSACTIONS).drop(KEY_COLUMN)


def stage_landed_days(df: DataFrame, zone: Zone) -> None:
    """Add days to a raw zone the way landing does (other days untouched)."""
    (df.select(*TRANSACTIONS.columns, *PARTITION_COLUMNS).write
     .mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITION_COLUMNS).option("header", "true").option("delimiter", ";")
     .csv(zone.raw_dataset_path(TRANSACTIONS)))


def q_landing_parse_date(spark, sf_dir):
    routed = route(list_drop(spark, drop_folder(spark, sf_dir)))
    return routed.select("object", "dataset",
                         F.date_format("batch_date", "yyyy-MM-dd").alias("batch_date"))


def _report(spark, sf_dir):
    return landing_report(spark, drop_folder(spark, sf_dir))


def q_landing_reject(spark, sf_dir):
    return _report(spark, sf_dir).where(F.col("status") != "ok").select("object", "status")


def q_landing_route(spark, sf_dir):
    return (_report(spark, sf_dir).where(F.col("status") == "ok")
            .select("object", "dataset", "destination"))


def q_landing_quality(spark, sf_dir):
    return _report(spark, sf_dir).select("object", "rows", "long_rows", "short_rows", "status")


def _object_counts(spark, zone, spec):
    return (scan_raw_backfill(spark, zone, spec, every_object=True)
            .groupBy("object", *PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("dataset", F.lit(spec.name)).select("dataset", "object", *PARTITION_COLUMNS, "n_rows"))


def q_landing_write(spark, sf_dir):
    """Rows that each landed object holds in the raw zone."""
    zone, report = landed(spark, sf_dir)
    out = None
    for spec in DATASETS.values():
        part = _object_counts(spark, zone, spec)
        out = part if out is None else out.unionByName(part)
    return out


def q_landing_quarantine(spark, sf_dir):
    """Rejected objects, the empty one among them, with reason and kept lines."""
    zone, report = landed(spark, sf_dir)
    return scan_quarantine(spark, zone).select("object", "status", (F.col("bytes") > 0).alias("has_bytes"))


def _land_providers(spark, sf_dir, zone, objects: dict):
    drop = f"{scratch_dir(spark, 'drop')}/drop"
    for name, keep in objects.items():
        fx.stage_object(fx.raw_providers(spark, sf_dir).where(keep), drop, name)
    return land_drop(spark, drop, zone)


def q_landing_two_drops(spark, sf_dir):
    """A second object for a landed day is kept beside the first, and so is a repeated
    drop; curation reads the day's own file only."""
    zone = _zone(spark, "two_drops", sf_dir)
    for objects in ({"Providers_20231204.csv": "true"}, {"Providers_20231204_v2.csv": "tipo_energia = 'solar'"},
                    {"Providers_20231204.csv": "true", "Providers_20231205.csv": "tipo_energia = 'eolica'"}):
        _land_providers(spark, sf_dir, zone, objects)
    result = curate(spark, PROVIDERS, DAY, zone, sync=False)
    return _object_counts(spark, zone, PROVIDERS).select(
        "object", "n_rows", F.lit(result.rows).cast("long").alias("curated_rows"))


def q_landing_reland_empty(spark, sf_dir):
    """An object landed again without rows holds none; other days stay. Replacing the
    range empties the curated day."""
    zone = _zone(spark, "reland", sf_dir)
    _land_providers(spark, sf_dir, zone, {"Providers_20231204.csv": "true", "Providers_20231205.csv": "true"})
    curate_backfill(spark, PROVIDERS, zone, sync=False)
    _land_providers(spark, sf_dir, zone, {"Providers_20231204.csv": "false"})
    curate_backfill(spark, PROVIDERS, zone, DAY, BatchDate("20231231"), rerun="replace", sync=False)
    curated = _day_counts(scan_curated(spark, zone.curated_path(PROVIDERS), PROVIDERS), "curated_rows")
    return _object_counts(spark, zone, PROVIDERS).join(curated, list(PARTITION_COLUMNS), "full").select(
        "object", *PARTITION_COLUMNS, "n_rows", "curated_rows")


def q_curate_extra_column(spark, sf_dir):
    """Objects with their columns in another order, and with a further one, curated by name."""
    zone, report = landed(spark, sf_dir)
    target = Zone(zone.raw_root, _zone(spark, "extra", sf_dir).curated_root, zone.env)
    for day in ("20231207", "20231209"):
        curate(spark, CUSTOMERS, day, target, sync=False)
    return scan_curated(spark, target.curated_path(CUSTOMERS), CUSTOMERS, extra=("Pais",)).drop(KEY_COLUMN)


def q_replace_empty_range(spark, sf_dir):
    """All days curated, then the range replaced from a raw zone that lacks every other day."""
    zone = backfill_zone(spark, sf_dir)
    half = _zone(spark, "half", sf_dir)
    target = Zone(zone.raw_root, half.curated_root, zone.env)
    curate_backfill(spark, TRANSACTIONS, target, sync=False)
    fx.stage_raw_zone(fx.dated_transactions(spark, sf_dir).where("cast(day as int) % 2 = 0"), half, TRANSACTIONS)
    curate_backfill(spark, TRANSACTIONS, half, "20200101", "20291231", rerun="replace", sync=False)
    return _day_counts(scan_curated(spark, half.curated_path(TRANSACTIONS), TRANSACTIONS), "n_rows")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "query_hydro_sales": q_query_hydro_sales,
    "query_hydro_sales_day": q_query_hydro_sales_day,
    "scan_raw_csv": q_scan_raw_csv,
    "scan_raw_backfill": q_scan_raw_backfill,
    "scan_raw_legacy_backfill": q_scan_raw_legacy_backfill,
    "cast_providers": q_cast_providers,
    "cast_customers": q_cast_customers,
    "cast_transactions": q_cast_transactions,
    "upper_name": q_upper_name,
    "fill_null_zero": q_fill_null_zero,
    "surrogate_key": q_surrogate_key,
    "row_key": q_row_key,
    "partition_columns": q_partition_columns,
    "curate_providers": q_curate_providers,
    "curate_customers": q_curate_customers,
    "curate_transactions": q_curate_transactions,
    "filter_equality": q_filter_equality,
    "filter_range": q_filter_range,
    "partitioned_write": q_partitioned_write,
    "append_batch": q_append_batch,
    "catalog_sync": q_catalog_sync,
    "empty_batch": q_empty_batch,
    "curate_incremental": q_curate_incremental,
    "landing_parse_date": q_landing_parse_date,
    "landing_reject": q_landing_reject,
    "landing_route": q_landing_route,
    "landing_quality": q_landing_quality,
    "landing_write": q_landing_write,
    "landing_quarantine": q_landing_quarantine,
    "landing_two_drops": q_landing_two_drops,
    "landing_reland_empty": q_landing_reland_empty,
    "curate_extra_column": q_curate_extra_column,
    "replace_empty_range": q_replace_empty_range,
}
