"""The saved curated-table query: hydro sales above a price."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BatchDate
from ..operators.filters import all_of, energy_is, kind_is, on_day, price_above

# The saved query's output spelling, default arguments and text
# (identifiers in backticks for Spark SQL; ``{table}`` is the qualified name).
HYDRO_COLUMNS = ("Tipo_transaccion", "Nombre", "Cantidad_comprada", "Precio", "Tipo_energia")
HYDRO_ENERGY = "hidroelectrica"
HYDRO_KIND = "venta"
HYDRO_MIN_PRICE = 1000

HYDRO_SALES_SQL = """
SELECT Tipo_transaccion, Nombre, Cantidad_comprada, Precio, Tipo_energia
FROM {table}
WHERE tipo_energia = 'hidroelectrica'
  AND tipo_transaccion = 'venta'
  AND precio > 1000
"""


def hydro_sales(df: DataFrame, energy: str = HYDRO_ENERGY, kind: str = HYDRO_KIND,
                min_price: int = HYDRO_MIN_PRICE, day: BatchDate | str | None = None) -> DataFrame:
    """Filter + 5-column projection over a curated transactions table.

    All predicates reach the parquet scan (``PushedFilters``); with ``day`` the
    date predicate prunes every other date folder (``PartitionFilters``).
    """
    cond = all_of(energy_is(energy), kind_is(kind), price_above(min_price))
    if day is not None:
        day = day if isinstance(day, BatchDate) else BatchDate(day)
        cond = on_day(day) & cond
    return df.where(cond).select(*(F.col(c.lower()).alias(c) for c in HYDRO_COLUMNS))


def hydro_sales_sql(spark: SparkSession, table: str) -> DataFrame:
    """The saved query text, run by Spark SQL against a catalog table."""
    return spark.sql(HYDRO_SALES_SQL.format(table=table))
