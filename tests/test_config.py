import pytest

from jornada.config import (BatchDate, Zone, bucket_name, catalog_database, normalize_env,
                            table_options)
from jornada.spec import CUSTOMERS, PROVIDERS, TRANSACTIONS, spec_for


def test_batch_date_slices():
    b = BatchDate("20231204")
    assert (b.year, b.month, b.day) == ("2023", "12", "04")
    assert b.partition() == {"year": "2023", "month": "12", "day": "04"}


@pytest.mark.parametrize("text", ["2023124", "20231304", "20230229", "2023-12-04", "", "abcdefgh",
                                  "202312041"])
def test_batch_date_rejects(text):
    with pytest.raises(ValueError):
        BatchDate(text)


def test_leap_day_accepted():
    assert BatchDate("20240229").day == "29"


@pytest.mark.parametrize("env,expected", [("qa", "qc"), ("pdn", "pdn"), ("dev", "dev")])
def test_environment(env, expected):
    assert normalize_env(env) == expected
    assert catalog_database(env) == f"co_energy_marketer_curated_{expected}_rl"


def test_zone_naming():
    z = Zone.named("test_account", "qa")
    assert z.raw_root == "s3a://co-energy-marketer-raw-test_account-qc"
    assert z.curated_root == "s3a://co-energy-marketer-curated-test_account-qc"
    assert bucket_name("raw", "a", "pdn") == "co-energy-marketer-raw-a-pdn"
    b = BatchDate("20231204")
    assert z.raw_day_path(TRANSACTIONS, b).endswith("/Transactions/year=2023/month=12/day=04")
    assert z.legacy_raw_file(PROVIDERS, b).endswith("/Providers/2023/12/04/Providers_20231204.csv")
    assert z.curated_path(CUSTOMERS).endswith("/table-catalog/energy_customers")
    assert z.table_name(TRANSACTIONS) == "`co_energy_marketer_curated_qc_rl`.`energy_transactions`"


def test_table_options_golden():
    opts = table_options("test_database", "Curated_Table")
    assert opts["hoodie.table.name"] == "curated_table"
    assert opts["hoodie.datasource.write.storage.type"] == "COPY_ON_WRITE"
    assert opts["hoodie.datasource.write.operation"] == "bulk_insert"
    assert opts["hoodie.datasource.write.recordkey.field"] == "primary_key"
    assert opts["hoodie.datasource.write.precombine.field"] == "primary_key"
    assert opts["hoodie.datasource.hive_sync.database"] == "test_database"
    assert opts["hoodie.datasource.hive_sync.table"] == "curated_table"
    assert opts["hoodie.datasource.write.partitionpath.field"] == "year,month,day"
    assert len(opts) == 17


def test_specs():
    assert spec_for("Transactions").zero_fill == ("precio",)
    assert [f.name for f in TRANSACTIONS.curated_schema()][-4:] == ["primary_key", "year",
                                                                     "month", "day"]
    assert str(TRANSACTIONS.curated_type("precio")) == "IntegerType()"
    with pytest.raises(ValueError):
        spec_for("Ventas")
