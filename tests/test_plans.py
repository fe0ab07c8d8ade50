"""Plan shape: pushdown, pruning, and no shuffle in curation."""

from jornada import registry as R
from jornada.operators import curate_frame
from jornada.sources import scan_raw_day
from jornada.spec import CUSTOMERS, TRANSACTIONS

from conftest import SF_SMALL


def plan_of(df) -> str:
    """The text ``df.explain("formatted")`` prints."""
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_hydro_sales_pushes_filters_and_prunes_columns(spark):
    plan = plan_of(R.q_query_hydro_sales(spark, SF_SMALL))
    assert "GreaterThan(precio,1000)" in plan
    assert "EqualTo(tipo_energia,hidroelectrica)" in plan
    assert "EqualTo(tipo_transaccion,venta)" in plan
    assert "primary_key" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert "Batched: true" in plan
    assert "Exchange" not in plan


def test_hydro_sales_day_prunes_partitions(spark):
    plan = plan_of(R.q_query_hydro_sales_day(spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan


def test_curation_is_narrow(spark):
    zone = R.raw_day_zone(spark, SF_SMALL)
    df = curate_frame(scan_raw_day(spark, zone, TRANSACTIONS, R.DAY), TRANSACTIONS, R.DAY)
    plan = plan_of(df)
    assert "Exchange" not in plan and "Sort" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_clustered_backfill_sorts_once_without_shuffle(spark):
    from jornada.sinks import clustered
    from jornada.sources import scan_raw_backfill
    zone = R.backfill_zone(spark, SF_SMALL)
    df = clustered(curate_frame(scan_raw_backfill(spark, zone, TRANSACTIONS), TRANSACTIONS),
                   TRANSACTIONS)
    plan = plan_of(df)
    assert "Exchange" not in plan
    assert plan.count(") Sort [") == 1
    args = plan.split(") Sort [")[1].split("Arguments: [")[1].split("]")[0]
    keys = [k.split("#")[0] for k in args.split(", ")]
    assert keys == ["year", "month", "day", "tipo_energia", "tipo_transaccion"]


def test_landing_aggregates_in_hash_maps(spark):
    """No aggregation buffer holds a string, so no line is ever sorted."""
    from jornada.operators.landing import quality
    name = "Customers_20231204.csv"
    plan = plan_of(quality(spark, R.drop_folder(spark, SF_SMALL), [name], list(CUSTOMERS.columns)))
    assert "HashAggregate" in plan
    assert "SortAggregate" not in plan and ") Sort " not in plan
