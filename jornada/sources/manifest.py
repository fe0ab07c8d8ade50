"""What a raw zone holds: manifests that landing commits after the data.

Landed data lie in folders of their own,
``<Dataset>/year=/month=/day=/object=<name>/landing=<id>``, and are never overwritten.
Once a landing's data are complete, one row per object is added under
``_manifest/dataset=/year=/month=/day=``. The newest row of an object says which
columns and which folder it has (no folder: no rows), so an object replaces only
itself, a failed write leaves nothing that is read, and the manifests of one day are
all that a daily run lists.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BatchDate, Zone
from ..spec import PARTITION_COLUMNS, TableSpec

_TEXT = T.StringType()
MANIFEST_SCHEMA = T.StructType([
    T.StructField("object", _TEXT), T.StructField("columns", T.ArrayType(_TEXT)),
    T.StructField("folder", _TEXT), T.StructField("rows", T.LongType()),
    T.StructField("landing", _TEXT), T.StructField("seq", T.LongType()),
    T.StructField("dataset", _TEXT), *(T.StructField(c, _TEXT) for c in PARTITION_COLUMNS)])

# The characters that Spark's partitioned writer escapes in folder names.
_ESCAPED = "".join(map(chr, range(1, 32))) + "\"#%'*/:=?\\\x7f{[]^"


def folder_name(value: str) -> str:
    """A partition value as Spark's partitioned writer spells it in a path."""
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def object_folder(batch: BatchDate, name: str, landing: str) -> str:
    """Folder of one landed object, relative to its dataset's."""
    day = "/".join(f"{k}={v}" for k, v in batch.partition().items())
    return f"{day}/object={folder_name(name)}/landing={landing}"


def day_object(spec: TableSpec, batch: BatchDate) -> str:
    """The one object that curation reads for a dataset and day."""
    return f"{spec.name}_{batch.text}.csv"


def manifest_root(zone: Zone) -> str:
    return f"{zone.raw_root.rstrip('/')}/_manifest"


def dataset_manifest(zone: Zone, spec: TableSpec) -> str:
    return f"{manifest_root(zone)}/dataset={spec.name}"


def load_if_there(load):
    """The result of ``load()``; None where its path does not exist. Other errors are raised."""
    try:
        return load()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _read(spark: SparkSession, zone: Zone, path: str) -> DataFrame | None:
    return load_if_there(lambda: spark.read.schema(MANIFEST_SCHEMA).option("basePath", manifest_root(zone))
                         .parquet(path))


def commit(entries: DataFrame, zone: Zone) -> None:
    """Add manifest rows (the columns of MANIFEST_SCHEMA), one file for each dataset and day."""
    (entries.select(*MANIFEST_SCHEMA.names).repartition("dataset", *PARTITION_COLUMNS).write.mode("append")
     .partitionBy("dataset", *PARTITION_COLUMNS).parquet(manifest_root(zone)))


def has_manifest(spark: SparkSession, zone: Zone, spec: TableSpec) -> bool:
    return _read(spark, zone, dataset_manifest(zone, spec)) is not None


def landed_objects(spark: SparkSession, zone: Zone, spec: TableSpec, day: BatchDate | None = None,
                   start: BatchDate | None = None, end: BatchDate | None = None) -> list[Row] | None:
    """The newest manifest row of every object of a day or a closed date range.

    None if the dataset has no manifest. One row per object reaches the driver, as for
    any file listing. For a day, only that day's manifests are listed.
    """
    root = dataset_manifest(zone, spec)
    rows = _read(spark, zone, root if day is None else
                 root + "".join(f"/{k}={v}" for k, v in day.partition().items()))
    if rows is None:
        return [] if day is not None and has_manifest(spark, zone, spec) else None
    at = F.concat(*PARTITION_COLUMNS)
    for bound, keep in ((start, lambda b: at >= b.text), (end, lambda b: at <= b.text)):
        rows = rows if bound is None else rows.where(keep(bound))
    newest = rows.groupBy(*PARTITION_COLUMNS, "object").agg(
        F.max_by(F.struct("columns", "folder", "rows", "landing"), F.struct("seq", "landing")).alias("e"))
    return newest.select(*PARTITION_COLUMNS, "object", "e.*").orderBy(*PARTITION_COLUMNS, "object").collect()
