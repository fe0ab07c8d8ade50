"""Row-wise curation steps. Every one is DataFrame -> DataFrame and narrow:
no step shuffles, and Catalyst collapses them into one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..config import BatchDate
from ..functions import cast_expr
from ..spec import KEY_COLUMN, PARTITION_COLUMNS, TableSpec, quoted


def cast_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Give each spec column its curated type, in place (one projection).

    Columns the spec does not name pass through as read.
    """
    present = {c.lower() for c in df.columns}
    missing = [c for c in spec.columns if c.lower() not in present]
    if missing:
        raise ValueError(f"{spec.name}: raw data lacks columns {missing}")
    return df.withColumns({c: cast_expr(c, spec.curated_type(c)) for c in spec.columns})


def upper_column(df: DataFrame, column: str) -> DataFrame:
    """Upper-case one text column."""
    return df.withColumn(column, F.upper(F.col(column)))


def upper_columns(df: DataFrame, columns) -> DataFrame:
    cols = list(columns)
    if not cols:
        return df
    return df.withColumns({c: F.upper(F.col(c)) for c in cols})


def fill_zero(df: DataFrame, column: str) -> DataFrame:
    """Null -> 0 in one numeric column; a missing column is an error."""
    if column.lower() not in {c.lower() for c in df.columns}:
        raise ValueError(f"column {column!r} does not exist in the DataFrame")
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(0)))


def surrogate_key() -> Column:
    """1-based id, unique within one run, computed per task without a shuffle.

    Values are not dense (each partition starts at ``index << 33``) and restart
    every run; use :func:`row_key` for a key that repeats across runs.
    """
    return F.monotonically_increasing_id() + F.lit(1)


def add_surrogate_key(df: DataFrame) -> DataFrame:
    return df.withColumn(KEY_COLUMN, surrogate_key())


def row_key(columns) -> Column:
    """Repeatable content key: SHA-256 of the natural columns.

    Each value is preceded by its length (nulls by ``n``), so no two different rows
    spell the same text.
    """
    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n"))
    return F.sha2(F.concat_ws("|", *map(part, columns)), 256)


def add_partition_columns(df: DataFrame, batch: BatchDate) -> DataFrame:
    """Constant ``year``/``month``/``day`` text columns of one batch date."""
    return df.withColumns({
        "year": F.lit(batch.year),
        "month": F.lpad(F.lit(batch.month), 2, "0"),
        "day": F.lpad(F.lit(batch.day), 2, "0"),
    })


def curate_frame(raw: DataFrame, spec: TableSpec, batch: BatchDate | None = None,
                 observation: Observation | None = None) -> DataFrame:
    """Raw text rows -> curated rows: key, date columns, casts, upper, zero fill.

    With ``batch`` the date columns are constants; without it they must already
    be on ``raw`` (a multi-date scan of the raw zone carries them as columns).
    Output order: raw columns, ``primary_key``, ``year``, ``month``, ``day``.

    With ``observation``, the same pass records ``rows`` and, per int column,
    ``unparsed_<c>`` (text present but not a number) and, per zero-filled
    column, ``zero_filled_<c>``; only null tests are added, the cast runs once.
    """
    df = raw
    if batch is not None:
        df = df.drop(*[c for c in PARTITION_COLUMNS if c in df.columns])
    data_cols = [c for c in df.columns if c not in PARTITION_COLUMNS]
    df = add_surrogate_key(df)
    if batch is not None:
        df = add_partition_columns(df, batch)
    flags = {f"__raw_null_{c}": F.col(c).isNull() for c in spec.int_columns}
    if observation is not None and flags:
        df = df.withColumns(flags)
    df = cast_columns(df, spec)
    if observation is not None:
        df = df.observe(observation, *_quality_metrics(spec))
        df = df.drop(*flags)
    df = upper_columns(df, spec.upper)
    for c in spec.zero_fill:
        df = fill_zero(df, c)
    names = {c.lower(): c for c in df.columns}
    ordered = [names[c.lower()] for c in data_cols] + [KEY_COLUMN, *PARTITION_COLUMNS]
    return df.select(*map(quoted, ordered))


def _quality_metrics(spec: TableSpec) -> list[Column]:
    metrics = [F.count(F.lit(1)).alias("rows")]
    for c in spec.int_columns:
        bad = F.col(c).isNull() & ~F.col(f"__raw_null_{c}")
        metrics.append(F.sum(bad.cast("long")).alias(f"unparsed_{c}"))
    for c in spec.zero_fill:
        metrics.append(F.sum(F.col(c).isNull().cast("long")).alias(f"zero_filled_{c}"))
    return metrics
