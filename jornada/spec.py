"""Declarative dataset specs: one ``TableSpec`` per curated dataset.

A fourth dataset is a new spec, not new code: every job, source and sink is
driven by these fields.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PARTITION_COLUMNS = ("year", "month", "day")
KEY_COLUMN = "primary_key"


def quoted(name: str) -> str:
    """A name as one SQL identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class TableSpec:
    """What a raw file holds and how its curated table is typed."""

    name: str                      # dataset token: file prefix and raw folder
    table: str                     # curated table name in the catalog
    columns: tuple[str, ...]       # raw columns, in file order
    int_columns: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    zero_fill: tuple[str, ...] = ()
    # Columns each output file is sorted by, so parquet min/max statistics let
    # filters on them skip pages and row groups (a per-task sort, no shuffle).
    cluster_by: tuple[str, ...] = ()

    def raw_schema(self) -> T.StructType:
        """Every raw column is text on read."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])

    def raw_partitioned_schema(self) -> T.StructType:
        """Raw schema plus the date directories of the raw zone, kept as strings."""
        return T.StructType(self.raw_schema().fields + _partition_fields())

    def curated_type(self, column: str) -> T.DataType:
        return T.IntegerType() if column in self.int_columns else T.StringType()

    def curated_schema(self) -> T.StructType:
        fields = [T.StructField(c, self.curated_type(c), True) for c in self.columns]
        fields.append(T.StructField(KEY_COLUMN, T.LongType(), False))
        return T.StructType(fields + _partition_fields())


def _partition_fields() -> list[T.StructField]:
    return [T.StructField(c, T.StringType(), True) for c in PARTITION_COLUMNS]


# Dataset names, table names and column names of the three
# curated datasets, as the raw files and the catalog spell them.
PROVIDERS = TableSpec(
    name="Providers",
    table="energy_providers",
    columns=("nombre_proveedor", "tipo_energia"),
    upper=("nombre_proveedor",),
)
CUSTOMERS = TableSpec(
    name="Customers",
    table="energy_customers",
    columns=("tipo_identificacion", "identificacion", "nombre", "ciudad"),
    upper=("nombre",),
)
TRANSACTIONS = TableSpec(
    name="Transactions",
    table="energy_transactions",
    columns=("tipo_transaccion", "nombre", "cantidad_comprada", "precio", "tipo_energia"),
    int_columns=("cantidad_comprada", "precio"),
    upper=("nombre",),
    zero_fill=("precio",),
    cluster_by=("tipo_energia", "tipo_transaccion"),
)

DATASETS: dict[str, TableSpec] = {s.name: s for s in (PROVIDERS, CUSTOMERS, TRANSACTIONS)}


def spec_for(name: str) -> TableSpec:
    try:
        return DATASETS[name]
    except KeyError:
        raise ValueError(f"unknown dataset {name!r}; expected one of {sorted(DATASETS)}") from None
