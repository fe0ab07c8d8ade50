import pytest
from pyspark.sql import functions as F

from jornada.config import BatchDate
from jornada.operators import (add_partition_columns, cast_columns, curate_frame, fill_zero,
                               row_key, upper_column)
from jornada.spec import TRANSACTIONS


def raw_tx(spark, rows):
    return spark.createDataFrame(rows, TRANSACTIONS.raw_schema())


def test_upper_keeps_accents_and_nulls(spark):
    df = spark.createDataFrame([("josé ñandú",), (None,)], "nombre string")
    assert [r.nombre for r in upper_column(df, "nombre").collect()] == ["JOSÉ ÑANDÚ", None]


def test_fill_zero_missing_column_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        fill_zero(df, "precio")


def test_fill_zero_after_cast(spark):
    df = raw_tx(spark, [("venta", "x", "3", "abc", "solar"), ("venta", "x", "3", None, "solar")])
    out = fill_zero(cast_columns(df, TRANSACTIONS), "precio")
    assert [r.precio for r in out.collect()] == [0, 0]


@pytest.mark.parametrize("date,month,day", [("20230404", "04", "04"), ("20231231", "12", "31")])
def test_partition_columns_padded(spark, date, month, day):
    df = add_partition_columns(spark.range(1), BatchDate(date))
    r = df.first()
    assert (r.year, r.month, r.day) == (date[:4], month, day)


def test_curate_frame_order_types_and_values(spark):
    df = raw_tx(spark, [("venta", "proveedor 7", "12.9", "1000.7", "hidroelectrica"),
                        ("compra", "josé", " 3 ", None, "solar")])
    out = curate_frame(df, TRANSACTIONS, BatchDate("20231204"))
    assert out.columns == list(TRANSACTIONS.columns) + ["primary_key", "year", "month", "day"]
    types = dict(out.dtypes)
    assert types["cantidad_comprada"] == "int" and types["precio"] == "int"
    assert types["primary_key"] == "bigint"
    rows = sorted(out.collect(), key=lambda r: r.primary_key)
    assert [(r.nombre, r.cantidad_comprada, r.precio) for r in rows] == [
        ("PROVEEDOR 7", 12, 1000), ("JOSÉ", 3, 0)]
    assert {r.year + r.month + r.day for r in rows} == {"20231204"}
    assert len({r.primary_key for r in rows}) == 2 and min(r.primary_key for r in rows) >= 1


def test_capitalised_header_is_renamed_by_cast(spark):
    df = spark.createDataFrame([("a", "b", "1", "2", "c")],
                               "tipo_transaccion string, Nombre string, cantidad_comprada string, "
                               "precio string, tipo_energia string")
    out = curate_frame(df, TRANSACTIONS, BatchDate("20231204"))
    assert "nombre" in out.columns and out.first().nombre == "B"


def test_missing_spec_column_raises(spark):
    df = spark.createDataFrame([("a",)], "tipo_transaccion string")
    with pytest.raises(ValueError):
        cast_columns(df, TRANSACTIONS)


def test_row_key_repeatable_and_null_aware(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    keys = [r.k for r in df.select(row_key(["x", "y"]).alias("k")).collect()]
    assert keys[0] == keys[2] and keys[0] != keys[1]


def test_surrogate_key_unique_across_partitions(spark):
    df = spark.range(0, 10_000, numPartitions=7).select(F.col("id").cast("string").alias("v"))
    df = df.select(F.lit("venta").alias("tipo_transaccion"), F.col("v").alias("nombre"),
                   F.col("v").alias("cantidad_comprada"), F.col("v").alias("precio"),
                   F.lit("solar").alias("tipo_energia"))
    out = curate_frame(df, TRANSACTIONS, BatchDate("20231204"))
    agg = out.agg(F.count("*").alias("n"), F.countDistinct("primary_key").alias("d"),
                  F.min("primary_key").alias("m")).first()
    assert (agg.n, agg.d, agg.m) == (10_000, 10_000, 1)


def test_observed_metrics(spark):
    from pyspark.sql import Observation
    df = raw_tx(spark, [("venta", "a", "x", "abc", "solar"), ("venta", "b", "1", None, "solar"),
                        ("venta", "c", None, "7.5", "solar")])
    obs = Observation("m")
    out = curate_frame(df, TRANSACTIONS, BatchDate("20231204"), observation=obs)
    assert out.columns == list(TRANSACTIONS.columns) + ["primary_key", "year", "month", "day"]
    assert sorted(r.precio for r in out.collect()) == [0, 0, 7]
    assert obs.get == {"rows": 3, "unparsed_cantidad_comprada": 1, "unparsed_precio": 1,
                       "zero_filled_precio": 2}


def test_is_empty_guard(spark):
    from jornada.operators import is_empty
    assert is_empty(spark.range(0))
    assert not is_empty(spark.range(3))
