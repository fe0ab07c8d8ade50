"""Landing: route dated raw drops into the raw zone as Spark jobs.

A drop folder holds objects named ``<Dataset>_<yyyyMMdd>[_anything].csv`` (a
plain file, or a folder of part files). Landing:

1. lists the folder and derives, per object, the dataset (name token 1), the batch
   date (token 2 up to the first ``.``, exactly 8 digits and a real day) and the
   destination folder; objects of other dates than the one asked for are not read;
2. finds each object's header line, groups objects by their columns and counts rows,
   short rows (missing fields, read as null) and long rows (surplus fields) with
   Spark's own CSV parser, the one that the rows are read with afterwards;
3. rejects objects with a bad name, an unknown dataset, no bytes, no header line with
   the dataset's columns (in any order; further columns are kept), any long row, or
   content that cannot be read, and keeps a copy with the reason under
   ``_quarantine``;
4. writes the rows of the others into folders of their own and then commits one
   manifest row per object (see :mod:`jornada.sources.manifest`).

Rejections are reported, never raised; an object that cannot be read does not stop the
others.
"""

from __future__ import annotations

import csv
import logging
import re
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..config import BatchDate, Zone
from ..sources.manifest import MANIFEST_SCHEMA, commit, object_folder
from ..sources.raw import DELIMITER, csv_reader
from ..spec import DATASETS, KEY_COLUMN, PARTITION_COLUMNS, TableSpec, quoted

log = logging.getLogger(__name__)

# Landing statuses.
OK = "ok"
REJECTED_NAME = "rejected_name"
REJECTED_DATASET = "rejected_dataset"
REJECTED_MALFORMED = "rejected_malformed"
REJECTED_HEADER = "rejected_header"
REJECTED_UNREADABLE = "rejected_unreadable"
REJECTED_EMPTY = "rejected_empty"
SKIPPED_DATE = "skipped_other_date"
FAILED_WRITE = "failed_write"

#: Column names a raw object can't have: they are the library's own.
RESERVED = (*PARTITION_COLUMNS, KEY_COLUMN, "object", "landing")
# Objects that one scan reads by name; longer lists are read batch by batch.
OBJECTS_PER_SCAN = 1_000
_CORRUPT = "_malformed_line"


def source_file() -> Column:
    """The row's source file as a plain path. ``_metadata.file_path`` is
    URL-encoded, while file listings are not; object names must agree."""
    return F.url_decode(F.col("_metadata.file_path"))


def _path_only(uri: str) -> str:
    """``scheme://authority/p`` or ``scheme:/p`` -> ``/p`` (plain paths unchanged)."""
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", uri)
    return (uri[m.end():] if m else uri).rstrip("/")


def object_name(path: Column, drop_dir: str) -> Column:
    """The element directly under the drop folder that a file belongs to."""
    root = _path_only(drop_dir)
    if not root.startswith("/"):  # relative to the working folder
        return F.regexp_extract(path, "/" + re.escape(root) + r"/([^/]+)", 1)
    return F.regexp_extract(path, "^([A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?)?" + re.escape(root) + r"/([^/]+)", 3)


def dataset_token(name: Column) -> Column:
    return F.split_part(name, F.lit("_"), F.lit(1))


def date_token(name: Column) -> Column:
    return F.split_part(F.split_part(name, F.lit("_"), F.lit(2)), F.lit("."), F.lit(1))


def parse_batch_date(token: Column) -> Column:
    """``yyyyMMdd`` -> date; null unless 8 digits forming a real calendar day."""
    parsed = F.try_to_timestamp(token, F.lit("yyyyMMdd")).cast("date")
    return F.when(token.rlike(r"^[0-9]{8}$"), parsed)


def destination(dataset: Column, batch_date: Column, name: Column) -> Column:
    """Raw-zone folder ``<Dataset>/year=yyyy/month=MM/day=dd/object=<name>``, relative to the raw root."""
    return F.concat_ws(
        "/", dataset,
        F.concat(F.lit("year="), F.date_format(batch_date, "yyyy")),
        F.concat(F.lit("month="), F.date_format(batch_date, "MM")),
        F.concat(F.lit("day="), F.date_format(batch_date, "dd")),
        F.concat(F.lit("object="), name))


def name_status(dataset: Column, batch_date: Column) -> Column:
    return (F.when(batch_date.isNull(), F.lit(REJECTED_NAME))
             .when(~dataset.isin(*DATASETS), F.lit(REJECTED_DATASET))
             .otherwise(F.lit(OK)))


def _listing(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Rows that the driver holds already (one per object), as a local relation: no task runs."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)), schema)


def list_drop(spark: SparkSession, drop_dir: str) -> DataFrame:
    """One row per object: name, files, bytes (file contents are not read).

    Names come from the scan's own file listing, since empty files give no rows.
    """
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .load(drop_dir))
    listed = _listing(spark, [{"path": p} for p in files.inputFiles()],
                      T.StructType([T.StructField("path", T.StringType())]))
    names = (listed.groupBy(object_name(F.url_decode("path"), drop_dir).alias("object"))
             .agg(F.count(F.lit(1)).alias("n_files")))
    sizes = (files.select("path", "length").groupBy(object_name(F.col("path"), drop_dir).alias("object"))
             .agg(F.sum("length").alias("bytes")))
    return names.join(sizes, "object", "left").select(
        "object", "n_files", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def route(objects: DataFrame) -> DataFrame:
    """Add dataset, batch date, name status and destination to an object list."""
    name = F.col("object")
    ds = dataset_token(name)
    day = parse_batch_date(date_token(name))
    return (objects
            .withColumn("dataset", F.when(ds.isin(*DATASETS), ds))
            .withColumn("batch_date", day)
            .withColumn("name_status", name_status(ds, day))
            .withColumn("destination",
                        F.when(F.col("name_status") == OK,
                               destination(F.col("dataset"), day, name))))


def _glob_escape(name: str) -> str:
    """Object name as a literal path: glob characters are escaped."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", name)


def _paths(drop_dir: str, objects: list[str]) -> list[str]:
    return [f"{drop_dir.rstrip('/')}/{_glob_escape(o)}" for o in objects]


def _batches(objects: list[str]) -> list[list[str]]:
    return [objects[at:at + OBJECTS_PER_SCAN] for at in range(0, len(objects), OBJECTS_PER_SCAN)]


def _isolated(objects: list[str], job: Callable[[list[str]], dict], failed: dict[str, Exception]) -> dict:
    """``job``'s results over all objects; one that makes it fail is found by halving
    and goes to ``failed``, the others are done."""
    try:
        return job(objects)
    except AnalysisException:  # a fault of the query, not of an object
        raise
    except Exception as exc:  # noqa: BLE001 - any reading error is that object's
        if len(objects) == 1:
            log.error("reading %s failed: %s", objects[0], exc)
            failed[objects[0]] = exc
            return {}
    half = len(objects) // 2
    return {**_isolated(objects[:half], job, failed), **_isolated(objects[half:], job, failed)}


def header_lines(spark: SparkSession, drop_dir: str, objects: list[str]) -> DataFrame:
    """(object, header) of the distinct header lines of each object's files: of each
    file, the first line that names all its dataset's columns."""
    lines = spark.read.option("recursiveFileLookup", "true").text(_paths(drop_dir, objects))
    low = F.lower("value")
    named = F.lit(False)
    for spec in DATASETS.values():
        own = F.col("dataset") == spec.name
        for c in spec.columns:
            own = own & low.contains(c.lower())
        named = named | own
    # The dataset is needed for lines with a column's name only.
    first_column = F.lit(False)
    for spec in DATASETS.values():
        first_column = first_column | low.contains(spec.columns[0].lower())
    found = (lines.where(first_column).select("value", F.monotonically_increasing_id().alias("at"),
                                              source_file().alias("file"))
             .withColumn("object", object_name(F.col("file"), drop_dir))
             .withColumn("dataset", dataset_token(F.col("object"))).where(named))
    return (found.groupBy("object", "file").agg(F.min_by("value", "at").alias("header"))
            .select("object", "header").distinct())


def header_columns(line: str, spec: TableSpec) -> list[str] | None:
    """Column names of a header line, the dataset's own in its spelling; None if one of
    these is missing or a name is empty, repeated or reserved."""
    names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=DELIMITER), [])
    own = {c.lower(): c for c in spec.columns}
    names = [own.get(n.lower(), n) for n in names]
    low = [n.lower() for n in names]
    bad = (not set(own) <= set(low) or len(set(low)) < len(low) or "" in low
           or any(n in RESERVED for n in low))
    return None if bad else names


def read_objects(spark: SparkSession, drop_dir: str, objects: list[str], columns: list[str],
                 malformed: bool = False) -> DataFrame:
    """Rows of objects that all have these columns in this order, with their object's
    name; the reader checks each file's header. ``malformed`` adds the text of lines
    with missing or surplus fields."""
    names = [*columns, *([_CORRUPT] if malformed else [])]
    reader = csv_reader(spark, T.StructType([T.StructField(c, T.StringType()) for c in names]))
    if malformed:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    out = None
    for batch in _batches(objects):
        part = (reader.option("recursiveFileLookup", "true").load(_paths(drop_dir, batch))
                .withColumn("object", object_name(source_file(), drop_dir)))
        out = part if out is None else out.unionByName(part)
    return out


def quality(spark: SparkSession, drop_dir: str, objects: list[str], columns: list[str]) -> DataFrame:
    """Per object: data rows, long rows (surplus fields) and short rows (missing fields),
    as Spark's CSV parser sees them. Only counts are aggregated, so a huge object is no
    hot spot and no line is sorted.

    A malformed line is short if it parses with fewer columns, else long.
    """
    line = F.col(_CORRUPT)
    options = {"delimiter": DELIMITER, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    short = F.lit(False)
    for n in range(1, len(columns)):
        schema = ", ".join([*(f"c{i} string" for i in range(n)), "bad string"])
        short = short | F.from_csv(line, schema, options)["bad"].isNull()
    rows = read_objects(spark, drop_dir, objects, columns, malformed=True)
    kind = F.when(line.isNull(), 0).when(short, 1).otherwise(2)
    # Looks at all columns, so none is pruned from the parser's check of a line's length.
    filled = sum((F.col(quoted(c)).isNotNull().cast("int") for c in columns), F.lit(0))
    return (rows.select("object", kind.alias("kind"), filled.alias("filled")).groupBy("object")
            .agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("kind") == 2).alias("long_rows"),
                 F.count_if(F.col("kind") == 1).alias("short_rows"), F.sum("filled").alias("filled_fields")))


_EXAMINED = T.StructType([
    T.StructField("rows", T.LongType()), T.StructField("long_rows", T.LongType()),
    T.StructField("short_rows", T.LongType()), T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("status", T.StringType())])


def _examined(spark: SparkSession, drop_dir: str, objects: dict[str, str]) -> dict[str, tuple]:
    """Object -> the fields of _EXAMINED, for objects by dataset."""
    failed: dict[str, Exception] = {}

    def headers(names: list[str]) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        for r in header_lines(spark, drop_dir, names).collect():
            found.setdefault(r.object, []).append(r.header)
        return found

    lines: dict[str, list[str]] = {}
    for batch in _batches(sorted(objects)):
        lines.update(_isolated(batch, headers, failed))
    columns: dict[str, list[str]] = {}
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, dataset in objects.items():
        found = [header_columns(line, DATASETS[dataset]) for line in lines.get(name, [])]
        if found and None not in found and all(f == found[0] for f in found):
            columns[name] = found[0]
            groups.setdefault(tuple(found[0]), []).append(name)
    without = [n for n in objects if n not in columns and n not in failed]

    def blank(names: list[str]) -> dict[str, bool]:
        text = spark.read.option("recursiveFileLookup", "true").text(_paths(drop_dir, names))
        seen = (text.where(F.trim("value") != "").select(object_name(source_file(), drop_dir).alias("object"))
                .distinct().collect())
        return {r.object: True for r in seen}

    counts: dict[str, tuple] = {}

    def count(names: list[str], of: tuple[str, ...]) -> dict[str, tuple]:
        return {r.object: (r.rows, r.long_rows, r.short_rows)
                for r in quality(spark, drop_dir, names, list(of)).collect()}

    with ThreadPoolExecutor(max_workers=4) as pool:
        jobs = [(batch, of) for of, names in groups.items() for batch in _batches(names)]
        texts = pool.submit(lambda: _isolated(without, blank, failed) if without else {})
        for done in pool.map(lambda j: _isolated(j[0], lambda names: count(names, j[1]), failed), jobs):
            counts.update(done)
        filled = texts.result()

    def outcome(name: str) -> tuple:
        if name in failed:
            bad_header = "CSV header" in str(failed[name])
            return None, None, None, None, REJECTED_HEADER if bad_header else REJECTED_UNREADABLE
        if name not in columns:
            return None, None, None, None, REJECTED_HEADER if name in filled else REJECTED_UNREADABLE
        rows, long_rows, short_rows = counts.get(name, (0, 0, 0))
        return rows, long_rows, short_rows, columns[name], REJECTED_MALFORMED if long_rows else OK

    return {name: outcome(name) for name in objects}


def landing_report(spark: SparkSession, drop_dir: str, batch: BatchDate | None = None) -> DataFrame:
    """Manifest of a drop folder: routing, quality counts, columns and final status.

    With ``batch`` only objects of that date are read; the others are skipped. One row
    per object reaches the driver, as in any file listing.
    """
    day = F.to_date(F.lit(batch.text), "yyyyMMdd") if batch is not None else F.col("batch_date")
    status = (F.when(F.col("name_status") != OK, F.col("name_status"))
               .when(F.col("batch_date") != day, F.lit(SKIPPED_DATE))
               .when(F.col("bytes") == 0, F.lit(REJECTED_EMPTY)).otherwise(F.lit(OK)))
    routed = route(list_drop(spark, drop_dir)).withColumn("name_status", status)
    listed = routed.select("object", "dataset", "batch_date", "destination", "n_files", "bytes", "name_status")
    rows = listed.collect()
    found = _examined(spark, drop_dir, {r.object: r.dataset for r in rows if r.name_status == OK})
    schema = T.StructType([f for f in listed.schema if f.name != "name_status"] + _EXAMINED.fields)
    merged = []
    for r in rows:
        row = r.asDict()
        row["status"] = row.pop("name_status")
        merged.append({**row, **dict(zip(_EXAMINED.names, found.get(r.object, ())))})
    return _listing(spark, merged, schema)


def write_objects(rows: DataFrame, zone: Zone, spec: TableSpec, landing: str) -> None:
    """Write rows with ``object`` and date columns into the objects' folders of a landing."""
    (rows.withColumn("landing", F.lit(landing)).write.mode("append")
     .partitionBy(*PARTITION_COLUMNS, "object", "landing")
     .option("header", "true").option("delimiter", DELIMITER)
     .csv(zone.raw_dataset_path(spec)))


def quarantine(spark: SparkSession, drop_dir: str, report: DataFrame, zone: Zone, landing: str) -> None:
    """Keep rejected objects: a row with the reason for each, and the lines of those that
    have any and can be read."""
    root = f"{zone.raw_root.rstrip('/')}/_quarantine/landing={landing}"
    rejected = report.where(F.col("status").startswith("rejected"))
    names = [r.object for r in rejected.where(
        (F.col("bytes") > 0) & (F.col("status") != REJECTED_UNREADABLE)).select("object").collect()]

    def lines(i: int, batch: list[str]) -> None:
        (spark.read.option("recursiveFileLookup", "true").text(_paths(drop_dir, batch))
         .select("value", object_name(source_file(), drop_dir).alias("object"))
         .write.partitionBy("object").text(f"{root}/lines/{i}"))

    with ThreadPoolExecutor(max_workers=2) as pool:
        kept = [pool.submit(lines, i, batch) for i, batch in enumerate(_batches(names))]
        rejected.select("object", "status", "n_files", "bytes").coalesce(1).write.parquet(f"{root}/objects")
        for job in kept:
            job.result()


def scan_quarantine(spark: SparkSession, zone: Zone) -> DataFrame:
    """Every rejected object with its reason: landing, object, status, n_files, bytes."""
    return spark.read.option("basePath", f"{zone.raw_root.rstrip('/')}/_quarantine").parquet(
        f"{zone.raw_root.rstrip('/')}/_quarantine/landing=*/objects").select(
        "landing", "object", "status", "n_files", "bytes")


def land(spark: SparkSession, drop_dir: str, zone: Zone,
         report: DataFrame | None = None) -> DataFrame:
    """Land every accepted object of a drop folder; returns the report.

    Data first, one write per dataset and set of columns (datasets side by side; one
    landing of a zone runs at a time); then the manifest rows of what was written whole. Landing an object again replaces what its
    name held, also by nothing. A write that fails leaves no manifest row, so its
    objects can land later; it does not stop the others and is raised at the end.
    """
    if report is None:
        report = landing_report(spark, drop_dir)
    rows = report.collect()
    landing, seq = uuid.uuid4().hex, time.time_ns()
    groups: dict[str, dict[tuple, list]] = {}
    for r in rows:
        if r.status == OK:
            groups.setdefault(r.dataset, {}).setdefault(tuple(r["columns"]), []).append(r)

    def write(dataset: str) -> list[tuple]:
        # One write of a folder at a time: writers of the same folder share a staging area.
        out = []
        for columns, objects in groups[dataset].items():
            try:
                _write_group(spark, drop_dir, zone, DATASETS[dataset], list(columns), objects, landing)
                out.append((dataset, objects, None))
            except Exception as exc:  # noqa: BLE001 - the others still land
                log.error("landing %s failed: %s", dataset, exc)
                out.append((dataset, objects, exc))
        return out

    with ThreadPoolExecutor(max_workers=len(groups) + 1) as pool:
        kept = pool.submit(quarantine, spark, drop_dir, report, zone, landing)
        done = [d for part in pool.map(write, groups) for d in part]
        kept.result()
    failed = {r.object for _, objects, exc in done if exc is not None for r in objects}
    entries = []
    for dataset, objects, exc in done:
        for r in objects if exc is None else ():
            day = BatchDate(f"{r.batch_date:%Y%m%d}")
            folder = object_folder(day, r.object, landing) if r.rows else None
            entries.append(dict(zip(MANIFEST_SCHEMA.names, (
                r.object, r["columns"], folder, r.rows, landing, seq, dataset, *day.partition().values()))))
    if entries:
        commit(_listing(spark, entries, MANIFEST_SCHEMA), zone)
    final = [{**r.asDict(), **({"status": FAILED_WRITE} if r.object in failed else {})} for r in rows]
    report = _listing(spark, final, report.schema)
    report.coalesce(1).write.parquet(f"{zone.raw_root.rstrip('/')}/_landing/{landing}")
    errors = [(dataset, exc) for dataset, _, exc in done if exc is not None]
    if errors:
        names = ", ".join(sorted({d for d, _ in errors}))
        raise RuntimeError(f"landing failed for {names}; other datasets landed") from errors[0][1]
    return report


def _write_group(spark: SparkSession, drop_dir: str, zone: Zone, spec: TableSpec, columns: list[str],
                 objects: list, landing: str) -> None:
    """Write objects with the same columns; as many rows must arrive as were counted."""
    counted = sum(r.rows for r in objects)
    if not counted:
        return
    day = parse_batch_date(date_token(F.col("object")))
    arrived = Observation(f"land_{spec.name}_{uuid.uuid4().hex[:8]}")
    rows = read_objects(spark, drop_dir, sorted(r.object for r in objects), columns).select(
        *map(quoted, columns), "object", F.date_format(day, "yyyy").alias("year"), F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day")).observe(arrived, F.count(F.lit(1)).alias("rows"))
    write_objects(rows, zone, spec, landing)
    if arrived.get["rows"] != counted:
        raise RuntimeError(f"{spec.name}: {counted} rows were counted, {arrived.get['rows']} arrived")
