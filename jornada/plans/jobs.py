"""Whole jobs: curate one dataset for one date, curate a date range, land a drop.

All three curate datasets run through the same job; the spec says what differs.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from ..config import BatchDate, Zone, table_options
from ..operators.landing import land, landing_report
from ..operators.transforms import curate_frame
from ..sinks.curated import (clear_unwritten, clustered, curated_days, file_days, sync_catalog,
                             write_batch)
from ..sources.raw import (range_folders, scan_legacy_backfill, scan_raw, scan_raw_backfill,
                           scan_raw_day)
from ..spec import DATASETS, KEY_COLUMN, PARTITION_COLUMNS, TableSpec

log = logging.getLogger(__name__)


@dataclass
class CurateResult:
    """What one curate run did; counts come from the write itself (no extra scan)."""

    dataset: str
    path: str
    metrics: dict = field(default_factory=dict)
    table: str | None = None

    @property
    def rows(self) -> int:
        return int(self.metrics.get("rows") or 0)


def _run(spark: SparkSession, raw: DataFrame, spec: TableSpec, batch: BatchDate | None,
         zone: Zone, fmt: str, rerun: str, sync: bool, label: str,
         batches: list[BatchDate], start: BatchDate | None, end: BatchDate | None) -> CurateResult:
    """Curate and write; ``replace`` covers every date from ``start`` to ``end`` (open: all),
    so dates in it without rows are emptied. ``batches`` are the partitions to register."""
    obs = Observation(f"curate_{spec.name}_{label}_{uuid.uuid4().hex[:8]}")
    curated = clustered(curate_frame(raw, spec, batch, observation=obs), spec)
    path = zone.curated_path(spec)
    options = table_options(zone.database, spec.table) if fmt == "hudi" else None
    covered = range_folders(path, start, end)
    replaced = rerun == "replace" and fmt == "parquet"
    # A single date with rows is replaced by the write itself: nothing to compare.
    before = curated_days(spark, spec, covered) if replaced and batch is None else {}
    try:
        write_batch(curated, path, fmt=fmt, rerun=rerun, options=options)
    except Exception as exc:
        raise RuntimeError(f"writing {spec.name} for {label} to {path} failed") from exc
    result = CurateResult(spec.name, path, dict(obs.get))
    if replaced and batch is not None and result.rows == 0:
        before = curated_days(spark, spec, covered)
    if before:
        cleared = clear_unwritten(spark, spec, path, covered, before)
        log.info("%s %s: dates without rows cleared: %s", spec.name, label, [d.text for d in cleared])
    if result.rows == 0:
        log.info("empty batch for %s %s: nothing written", spec.name, label)
    elif sync and fmt == "parquet":
        extra = extra_columns(curated, spec)
        result.table = sync_catalog(spark, zone.database, spec, path, batches, **({"extra": extra} if extra else {}))
    log.info("curated %s %s: %s", spec.name, label, result.metrics)
    return result


def extra_columns(curated: DataFrame, spec: TableSpec) -> tuple[str, ...]:
    """Columns of a curated frame that the spec doesn't name: they pass through as text."""
    own = {c.lower() for c in (*spec.columns, KEY_COLUMN, *PARTITION_COLUMNS)}
    return tuple(c for c in curated.columns if c.lower() not in own)


def curate(spark: SparkSession, spec: TableSpec, batch: BatchDate | str, zone: Zone,
           fmt: str = "parquet", rerun: str = "append", sync: bool = True,
           raw_path: str | list[str] | None = None, per_file: bool = False) -> CurateResult:
    """Curate one dataset for one process date (raw zone -> curated table).

    ``raw_path`` overrides the raw-zone folder (e.g. a per-file legacy path); its
    column names then come from the header line. ``per_file`` names the dataset's one
    file of the layout ``<Dataset>/yyyy/MM/dd/<Dataset>_yyyyMMdd.csv`` that way.
    ``rerun="replace"`` with an empty batch leaves the date without rows.
    """
    batch = batch if isinstance(batch, BatchDate) else BatchDate(batch)
    if per_file and not raw_path:
        raw_path = zone.legacy_raw_file(spec, batch)
    raw = scan_raw(spark, raw_path) if raw_path else scan_raw_day(spark, zone, spec, batch)
    return _run(spark, raw, spec, batch, zone, fmt, rerun, sync, batch.text, [batch], batch, batch)


def curate_all(spark: SparkSession, batch: BatchDate | str, zone: Zone,
               specs=None, raise_errors: bool = True,
               **kwargs) -> dict[str, CurateResult | Exception]:
    """Curate every dataset of one date; the jobs run side by side on the cluster.

    Each dataset is its own job, as separate daily jobs would be: one failing
    (e.g. its raw day is missing) does not stop the others. With
    ``raise_errors`` the first failure is raised once all have finished;
    otherwise failures are returned in place of results.
    """
    specs = list(DATASETS.values()) if specs is None else list(specs)
    batch = batch if isinstance(batch, BatchDate) else BatchDate(batch)

    def one(spec: TableSpec):
        try:
            return curate(spark, spec, batch, zone, **kwargs)
        except Exception as exc:  # noqa: BLE001 - reported per dataset
            log.error("curating %s for %s failed: %s", spec.name, batch, exc)
            return exc

    with ThreadPoolExecutor(max_workers=max(1, len(specs))) as pool:
        results = dict(zip((s.name for s in specs), pool.map(one, specs)))
    if raise_errors:
        for r in results.values():
            if isinstance(r, Exception):
                raise r
    return results


def curate_backfill(spark: SparkSession, spec: TableSpec, zone: Zone,
                    start: BatchDate | str | None = None, end: BatchDate | str | None = None,
                    fmt: str = "parquet", rerun: str = "append",
                    sync: bool = True, per_file: bool = False) -> CurateResult:
    """Curate every raw day of a dataset in a date range in one job.

    ``per_file`` reads the layout of one file a day. ``rerun="replace"`` empties the dates
    of the range that have no raw rows, too. Only the dates read are registered.

    No shuffle: each task writes the dates of its own input (small day folders are
    packed several to a task), and a day holding most of the rows is simply spread
    over more tasks.
    """
    start = BatchDate(start) if isinstance(start, str) else start
    end = BatchDate(end) if isinstance(end, str) else end
    raw = (scan_legacy_backfill(spark, zone.raw_root, spec, start, end) if per_file
           else scan_raw_backfill(spark, zone, spec, start, end))
    label = f"{start or 'begin'}-{end or 'end'}"
    # The listing that the scan has made anyway names the dates; no job runs for it.
    days = [BatchDate(d) for d in sorted(file_days(raw.inputFiles()))
            if (start is None or d >= start.text) and (end is None or d <= end.text)]
    return _run(spark, raw, spec, None, zone, fmt, rerun, sync, label, days, start, end)


def land_drop(spark: SparkSession, drop_dir: str, zone: Zone,
              batch: BatchDate | str | None = None) -> DataFrame:
    """Land a drop folder (all dates, or only objects of ``batch``); returns the report."""
    batch = BatchDate(batch) if isinstance(batch, str) else batch
    return land(spark, drop_dir, zone, landing_report(spark, drop_dir, batch))
