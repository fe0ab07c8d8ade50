"""Predicates of the curated-table query, and the empty-batch guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BatchDate


def energy_is(energy: str) -> Column:
    """Case-sensitive equality on ``tipo_energia``."""
    return F.col("tipo_energia") == F.lit(energy)


def kind_is(kind: str) -> Column:
    """Case-sensitive equality on ``tipo_transaccion``."""
    return F.col("tipo_transaccion") == F.lit(kind)


def price_above(min_price: int) -> Column:
    """Strict range on the typed ``precio`` (pushed to the parquet scan)."""
    return F.col("precio") > F.lit(min_price)


def all_of(*predicates: Column) -> Column:
    out = predicates[0]
    for p in predicates[1:]:
        out = out & p
    return out


def on_day(batch: BatchDate) -> Column:
    """Partition predicate: Spark prunes the other date folders at planning time."""
    return all_of(*(F.col(k) == F.lit(v) for k, v in batch.partition().items()))


def is_empty(df: DataFrame) -> bool:
    """Cheap guard: stops at the first row found."""
    return df.isEmpty()
