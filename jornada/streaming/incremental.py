"""Incremental curation: a file stream over the raw zone re-curates changed days.

The stream follows the dataset's landing manifests, or, of a zone without any, lists
newly landed raw files (``binaryFile`` with the content column pruned, so no data is
read by the stream itself), and turns each micro-batch into the set of days that
changed. For those days the batch job reads what they hold now (nothing else is
listed), runs the same curation as the daily job, and replaces exactly those date
partitions; a day that holds no rows any more is emptied.

Replaying a micro-batch after a failure therefore rewrites the same days with
the same rows (idempotent), and re-landing a day re-curates it. Processed files are
tracked in the checkpoint.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import BatchDate, Zone
from ..operators.transforms import curate_frame
from ..plans.jobs import extra_columns
from ..sinks.curated import clear_unwritten, clustered, curated_days, sync_catalog, write_batch
from ..sources.manifest import MANIFEST_SCHEMA, dataset_manifest, has_manifest
from ..sources.raw import day_folders, scan_raw_days
from ..spec import PARTITION_COLUMNS, TableSpec

log = logging.getLogger(__name__)

_DAY_FOLDER = r"/year=([0-9]{4})/month=([0-9]{2})/day=([0-9]{2})/"
# The binaryFile source's fixed columns (the content column is never read).
_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


#: A hundred years: the file source must not skip files by age.
MAX_FILE_AGE = "36500d"


@dataclass
class BatchResult:
    """What one micro-batch did; counts come from its write (no extra scan)."""

    dataset: str
    batch_id: int
    days: list[BatchDate]
    metrics: dict = field(default_factory=dict)
    cleared: list[BatchDate] = field(default_factory=list)


def changed_days(files: DataFrame) -> DataFrame:
    """Distinct ``yyyyMMdd`` of new manifest rows, or of the day folders that files sit in."""
    if "path" not in files.columns:
        return files.select(F.concat(*PARTITION_COLUMNS).alias("day")).distinct()
    path = F.col("path")
    day = F.concat(*(F.regexp_extract(path, _DAY_FOLDER, i) for i in (1, 2, 3)))
    return files.select(day.alias("day")).where(F.length("day") == 8).distinct()


def curate_days(spark: SparkSession, spec: TableSpec, zone: Zone, days: list[BatchDate],
                fmt: str = "parquet", sync: bool = True, batch_id: int = 0) -> BatchResult:
    """Re-curate whole raw days and replace their curated partitions, also by nothing."""
    result = BatchResult(spec.name, batch_id, days)
    if not days:
        return result
    if fmt != "parquet":
        raise ValueError(f"the stream replaces dates, which is not supported for {fmt}")
    path = zone.curated_path(spec)
    folders = day_folders(path, days)
    try:
        before = curated_days(spark, spec, folders)
        obs = Observation(f"stream_{spec.name}_{batch_id}_{uuid.uuid4().hex[:8]}")
        curated = curate_frame(scan_raw_days(spark, zone, spec, days), spec, observation=obs)
        write_batch(clustered(curated, spec), path, fmt=fmt, rerun="replace")
        result.metrics = dict(obs.get)
        result.cleared = clear_unwritten(spark, spec, path, folders, before) if before else []
        if sync:
            sync_catalog(spark, zone.database, spec, path, days, extra_columns(curated, spec))
    except Exception as exc:
        span = f"{min(d.text for d in days)} to {max(d.text for d in days)}"
        raise RuntimeError(f"curating {spec.name}, batch {batch_id}, {len(days)} days from {span} failed") from exc
    log.info("curated %s batch %s: %s days, %s", spec.name, batch_id, len(days), result.metrics)
    return result


def curate_stream(spark: SparkSession, spec: TableSpec, zone: Zone,
                  checkpoint: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None, fmt: str = "parquet",
                  sync: bool = True,
                  on_batch: Callable[[BatchResult], None] | None = None) -> StreamingQuery:
    """Start the incremental curation stream of one dataset.

    ``available_now`` processes everything landed so far and stops; otherwise
    the query keeps running and picks up new days as they land. ``on_batch`` gets each
    micro-batch's days and counts.
    """
    checkpoint = checkpoint or f"{zone.curated_root.rstrip('/')}/_checkpoints/{spec.table}"
    # Days may be copied in with old file times: none is too old to be curated.
    reader = spark.readStream.option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if has_manifest(spark, zone, spec):
        own = T.StructType([f for f in MANIFEST_SCHEMA if f.name != "dataset"])
        files = reader.schema(own).parquet(dataset_manifest(zone, spec)).select(*PARTITION_COLUMNS)
    else:
        files = (reader.format("binaryFile").schema(_FILE_SCHEMA).option("recursiveFileLookup", "true")
                 .load(zone.raw_dataset_path(spec)).select("path"))

    def run(batch: DataFrame, batch_id: int) -> None:
        # One row per changed day: bounded by the calendar, not by the data.
        days = [BatchDate(r.day) for r in changed_days(batch).collect()]
        result = curate_days(spark, spec, zone, days, fmt=fmt, sync=sync, batch_id=batch_id)
        if on_batch is not None:
            on_batch(result)

    writer = (files.writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint)
              .queryName(f"curate_{spec.table}_{zone.env}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
