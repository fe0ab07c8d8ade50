"""Curated-table sinks: partitioned append/replace and catalog registration."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import BatchDate
from ..sources.manifest import load_if_there
from ..spec import PARTITION_COLUMNS, TableSpec, quoted

RERUN_MODES = ("append", "replace")


def write_batch(df: DataFrame, path: str, fmt: str = "parquet", rerun: str = "append",
                options: dict | None = None) -> None:
    """Write curated rows under ``year=/month=/day=`` folders.

    ``append`` adds files (running a date twice doubles it, as a bulk insert
    does). ``replace`` overwrites only the date folders present in ``df``
    (dynamic partition overwrite); other dates are untouched. No shuffle: each
    task writes the dates of its own rows.
    """
    if rerun not in RERUN_MODES:
        raise ValueError(f"rerun must be one of {RERUN_MODES}, got {rerun!r}")
    if fmt == "hudi" and rerun == "replace":
        # With bulk-insert options an overwrite recreates the table: other dates would go.
        raise ValueError("rerun='replace' is not supported for hudi tables")
    writer = df.write.format(fmt).partitionBy(*PARTITION_COLUMNS)
    if options and fmt != "parquet":
        writer = writer.options(**options)
    if rerun == "append":
        writer = writer.mode("append")
    else:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def clear_days(spark: SparkSession, spec: TableSpec, path: str, batches: list[BatchDate]) -> None:
    """Empty the given date folders: what replacing a date by an empty batch leaves.

    A dynamic overwrite without rows touches nothing, so each day is overwritten by
    path with a file that holds the schema and no row.
    """
    schema = T.StructType([f for f in spec.curated_schema() if f.name not in PARTITION_COLUMNS])
    none = spark.createDataFrame([], schema)
    for b in batches:
        day = "/".join(f"{k}={v}" for k, v in b.partition().items())
        none.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{day}")


def file_days(files: list[str]) -> dict[str, set[str]]:
    """Files by the date (``yyyyMMdd``) of their folder, in either raw layout or curated."""
    out: dict[str, set[str]] = {}
    for f in files:
        m = re.search(r"/year=([0-9]{4})/month=([0-9]{2})/day=([0-9]{2})/|/([0-9]{4})/([0-9]{2})/([0-9]{2})/[^/]+\.csv", f)
        if m:
            out.setdefault("".join(g for g in m.groups() if g), set()).add(f)
    return out


def curated_days(spark: SparkSession, spec: TableSpec, pattern: str) -> dict[str, set[str]]:
    """Files of the curated date folders that a path pattern names, by date."""
    df = load_if_there(lambda: spark.read.schema(spec.curated_schema()).parquet(pattern))
    return {} if df is None else file_days(df.inputFiles())


def clear_unwritten(spark: SparkSession, spec: TableSpec, path: str, pattern: str,
                    before: dict[str, set[str]]) -> list[BatchDate]:
    """Empty the dates of a replaced range that the write left as they were.

    ``before`` are the files of :func:`curated_days` before the write. A date that keeps
    one of them had no row in the batch.
    """
    after = curated_days(spark, spec, pattern)
    stale = [BatchDate(d) for d in sorted(before) if before[d] & after.get(d, set())]
    clear_days(spark, spec, path, stale)
    return stale


def clustered(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Sort each task's rows by date, then by the spec's cluster columns.

    The date prefix is the order the partitioned writer needs anyway, so this
    is the only sort; constant date columns (one-day runs) drop out of it.
    """
    if not spec.cluster_by:
        return df
    return df.sortWithinPartitions(*PARTITION_COLUMNS, *spec.cluster_by)


def _ddl_columns(spec: TableSpec) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.curated_schema())


def table_location(spark: SparkSession, name: str) -> str | None:
    """Location of a catalog table (one metadata row, read on the driver)."""
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if row.col_name == "Location":
            return row.data_type
    return None


def _norm(path: str) -> str:
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            path = path[len(prefix):]
    return path.rstrip("/")


def qualified_name(database: str, spec: TableSpec) -> str:
    """Quoted catalog name of a curated table."""
    return f"{quoted(database)}.{quoted(spec.table)}"


def sync_catalog(spark: SparkSession, database: str, spec: TableSpec, path: str,
                 batches: list[BatchDate] | None = None, extra: tuple[str, ...] = ()) -> str:
    """Register the curated folder as an external partitioned table.

    With ``batches`` only those date partitions are added (constant work per
    daily run); without, every date folder under ``path`` is discovered. ``extra`` are
    text columns beyond the spec's that the table should show.
    Returns the qualified table name.
    """
    name = qualified_name(database, spec)
    if not spark.catalog.tableExists(name):
        # First run only; later runs go straight to their partitions.
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_ddl_columns(spec)}) USING parquet "
            f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{escaped}'")
    registered = table_location(spark, name)
    if registered is not None and _norm(registered) != _norm(path):
        raise ValueError(f"{name} is registered at {registered}, not at {path}")
    if extra:
        known = {c.lower() for c in spark.table(name).columns}
        new = [c for c in extra if c.lower() not in known]
        if new:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(quoted(c) + ' string' for c in new)})")
    if batches is None:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    elif batches:
        days = " ".join("PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in b.partition().items())
                        + ")" for b in batches)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {days}")
    return name
