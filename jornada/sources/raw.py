"""Scans of the raw zone (delimited text) and of curated tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BatchDate, Zone
from ..spec import PARTITION_COLUMNS, TableSpec, quoted
from .manifest import day_object, has_manifest, landed_objects, load_if_there

# The raw file format.
DELIMITER = ";"
HEADER = "true"


def csv_reader(spark: SparkSession, schema=None, check_header: bool = True):
    """Raw-file reader. Fields are taken by position, so unless ``check_header``
    is off every file's header line must name the columns in order
    (case-insensitive): the given schema's, or the first file's when the names
    come from the header. A mismatch fails the read instead of shifting values
    into the wrong columns."""
    reader = (spark.read.format("csv")
              .option("header", HEADER)
              .option("delimiter", DELIMITER)
              .option("enforceSchema", str(not check_header).lower()))
    if schema is not None:
        reader = reader.schema(schema)
    return reader


def scan_raw(spark: SparkSession, path, spec: TableSpec | None = None) -> DataFrame:
    """Read one or more raw files/folders; every column is text.

    Without ``spec`` column names come from the first file's header line (one
    small job reads it). With ``spec`` the schema is given, so nothing is
    inferred. Either way every file's header must list the same columns in
    order.
    A missing path raises ``AnalysisException`` at load.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return csv_reader(spark, spec.raw_schema() if spec else None).load(paths)


def scan_landed(spark: SparkSession, zone: Zone, spec: TableSpec, objects: list[Row],
                with_object: bool = False) -> DataFrame:
    """Rows of landed objects (manifest rows), columns by name, with their date columns.

    Objects with the same header are one scan; columns that only some objects have are
    null in the others. Nothing but the objects' own folders is listed.
    """
    extra = ["object"] if with_object else []
    out = None
    groups: dict[tuple[str, ...], list[str]] = {}
    for o in objects:
        if o.folder is not None:
            groups.setdefault(tuple(o["columns"]), []).append(f"{zone.raw_dataset_path(spec)}/{o.folder}")
    for columns, folders in groups.items():
        fields = [*columns, *PARTITION_COLUMNS, "object", "landing"]
        part = (csv_reader(spark, T.StructType([T.StructField(c, T.StringType()) for c in fields]))
                .option("basePath", zone.raw_dataset_path(spec)).load(folders)
                .select(*map(quoted, columns), *PARTITION_COLUMNS, *extra))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], spec.raw_partitioned_schema())
        out = out.withColumn("object", F.lit(None).cast("string")) if with_object else out
    names = [c for c in out.columns if c not in (*PARTITION_COLUMNS, *extra)]
    return out.select(*map(quoted, names), *PARTITION_COLUMNS, *extra)


def scan_raw_day(spark: SparkSession, zone: Zone, spec: TableSpec,
                 batch: BatchDate) -> DataFrame:
    """One dataset and day: its ``<Dataset>_<date>.csv``, or the day's folder where the
    dataset's raw zone has no manifest (it was filled by another tool)."""
    objects = landed_objects(spark, zone, spec, batch)
    if objects is None:
        return scan_raw(spark, zone.raw_day_path(spec, batch), spec)
    wanted = [o for o in objects if o.object == day_object(spec, batch)]
    if not wanted:
        raise FileNotFoundError(f"[PATH_NOT_FOUND] {day_object(spec, batch)} has not landed in {zone.raw_root}")
    return scan_landed(spark, zone, spec, wanted).drop(*PARTITION_COLUMNS)


def date_range(start: BatchDate | None, end: BatchDate | None) -> Column | None:
    """Predicate on the date columns only, so it prunes folders at planning time."""
    day = F.concat(*(F.col(c) for c in PARTITION_COLUMNS))
    cond = None
    if start is not None:
        cond = day >= F.lit(start.text)
    if end is not None:
        upper = day <= F.lit(end.text)
        cond = upper if cond is None else cond & upper
    return cond


def date_cover(start: BatchDate, end: BatchDate) -> list[tuple[str, ...]]:
    """The closed range as whole years, whole months and days: (y,), (y, m) or (y, m, d)."""
    first, last = (dt.date(int(b.year), int(b.month), int(b.day)) for b in (start, end))
    out, at = [], first
    while at <= last:
        year_end = dt.date(at.year, 12, 31)
        month_end = (at.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        if (at.month, at.day) == (1, 1) and year_end <= last:
            out.append((f"{at:%Y}",))
            at = year_end
        elif at.day == 1 and month_end <= last:
            out.append((f"{at:%Y}", f"{at:%m}"))
            at = month_end
        else:
            out.append((f"{at:%Y}", f"{at:%m}", f"{at:%d}"))
        at += dt.timedelta(days=1)
    return out


def _one_of(parts: list[str]) -> str:
    return parts[0] if len(parts) == 1 else "{" + ",".join(parts) + "}"


def range_folders(root: str, start: BatchDate | None, end: BatchDate | None) -> str:
    """Path pattern of the day folders of a closed range that exist (open: the root)."""
    if start is None or end is None or end.text < start.text:
        return root
    return f"{root}/" + _one_of(["/".join(f"{k}={v}" for k, v in zip(PARTITION_COLUMNS, part))
                                 for part in date_cover(start, end)])


def day_folders(root: str, days: list[BatchDate]) -> str:
    """Path pattern of the folders of some days that exist."""
    return f"{root}/" + _one_of(["/".join(f"{k}={v}" for k, v in d.partition().items()) for d in days])


def scan_raw_backfill(spark: SparkSession, zone: Zone, spec: TableSpec,
                      start: BatchDate | None = None, end: BatchDate | None = None,
                      every_object: bool = False) -> DataFrame:
    """All raw days of a dataset (optionally a closed date range), with text columns
    ``year``/``month``/``day``.

    Of a landed zone, the ``<Dataset>_<date>.csv`` of each day is read, or with
    ``every_object`` all its objects, with an ``object`` column. A zone without a
    manifest is read by its day folders: of a closed range only the folders in it that
    exist are listed.
    """
    objects = landed_objects(spark, zone, spec, start=start, end=end)
    if objects is not None:
        own = [o for o in objects if every_object
               or o.object == f"{spec.name}_{o.year}{o.month}{o.day}.csv"]
        return scan_landed(spark, zone, spec, own, with_object=every_object)
    root = zone.raw_dataset_path(spec)
    read = lambda: (csv_reader(spark, spec.raw_partitioned_schema()).option("basePath", root)
                    .load(range_folders(root, start, end)))
    closed = start is not None and end is not None
    df = load_if_there(read) if closed else read()
    if df is None:  # no day of the range exists
        return spark.createDataFrame([], spec.raw_partitioned_schema())
    cond = date_range(start, end)
    return df if cond is None else df.where(cond)


def scan_raw_days(spark: SparkSession, zone: Zone, spec: TableSpec,
                  days: list[BatchDate]) -> DataFrame:
    """Exactly the given days, with their date columns.

    Only their manifests and folders are listed, so the cost does not grow with the
    length of the raw history.
    """
    if has_manifest(spark, zone, spec):
        objects = [o for d in days for o in landed_objects(spark, zone, spec, d) if o.object == day_object(spec, d)]
        return scan_landed(spark, zone, spec, objects)
    return (csv_reader(spark, spec.raw_partitioned_schema())
            .option("basePath", zone.raw_dataset_path(spec))
            .load([zone.raw_day_path(spec, d) for d in days]))


def scan_legacy_backfill(spark: SparkSession, raw_root: str, spec: TableSpec,
                         start: BatchDate | None = None, end: BatchDate | None = None) -> DataFrame:
    """Per-file raw layout ``<Dataset>/yyyy/MM/dd/<Dataset>_yyyyMMdd.csv``, optionally a
    closed date range, of which only the files that exist are listed.

    The batch date is read from each row's source file name.
    """
    root = f"{raw_root.rstrip('/')}/{spec.name}"
    paths = ["*/*/*"] if start is None or end is None or end.text < start.text else [
        "/".join([*part, *"*" * (3 - len(part))]) for part in date_cover(start, end)]
    df = load_if_there(lambda: csv_reader(spark, spec.raw_schema()).load(
        f"{root}/{_one_of(paths)}/{spec.name}_*.csv"))
    if df is None:
        return spark.createDataFrame([], spec.raw_partitioned_schema())
    token = F.regexp_extract(F.col("_metadata.file_path"),
                             rf"/{spec.name}_([0-9]{{8}})\.csv(/[^/]*)?$", 1)
    df = df.withColumns({
        "year": F.substring(token, 1, 4),
        "month": F.substring(token, 5, 2),
        "day": F.substring(token, 7, 2),
    }).where(F.col("year") != "")  # further objects of a day, such as _v2, are not curated
    cond = date_range(start, end)
    return df if cond is None else df.where(cond)


def scan_curated(spark: SparkSession, path: str, spec: TableSpec, extra: tuple[str, ...] = (),
                 days: list[BatchDate] | None = None) -> DataFrame:
    """Curated parquet by path; the explicit schema keeps ``month='01'`` as text.

    ``extra`` are text columns beyond the spec's. With ``days`` only their folders are
    listed.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in extra])
    schema = T.StructType(spec.curated_schema().fields[:-len(PARTITION_COLUMNS)] + schema.fields
                          + spec.curated_schema().fields[-len(PARTITION_COLUMNS):])
    return spark.read.schema(schema).option("basePath", path).parquet(day_folders(path, days) if days else path)


def scan_table(spark: SparkSession, zone: Zone, spec: TableSpec) -> DataFrame:
    """Curated table by catalog name (after :func:`jornada.sinks.sync_catalog`)."""
    return spark.table(zone.table_name(spec))
