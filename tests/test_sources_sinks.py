import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import write_text
from jornada.config import BatchDate, Zone
from jornada.plans import curate, curate_backfill, hydro_sales
from jornada.sinks import sync_catalog
from jornada.sources import scan_curated, scan_legacy_backfill, scan_raw, scan_raw_backfill
from jornada.spec import CUSTOMERS, PROVIDERS, TRANSACTIONS

HEADER = "tipo_transaccion;nombre;cantidad_comprada;precio;tipo_energia\n"


def test_csv_corner_cases(spark, workdir):
    text = ("tipo_identificacion;identificacion;nombre;ciudad\n"
            "CC;1;ana\n"                       # short row: null tail
            "CC;2;bo;cali;extra\n"             # surplus field: dropped
            'NIT;3;"x;y";bogota\n'             # quoted delimiter
            'NIT;4;"";pasto\n'                 # quoted empty: null
            "\n"                               # blank line: skipped
            "CC;5;  inner  spaces ;neiva\n")
    path = write_text(f"{workdir}/c.csv", text)
    rows = scan_raw(spark, path).orderBy(F.col("identificacion").cast("int")).collect()
    assert [tuple(r) for r in rows] == [
        ("CC", "1", "ana", None), ("CC", "2", "bo", "cali"), ("NIT", "3", "x;y", "bogota"),
        ("NIT", "4", None, "pasto"), ("CC", "5", "  inner  spaces ", "neiva")]
    assert scan_raw(spark, path).columns == list(CUSTOMERS.columns)


def test_missing_file_raises(spark, workdir):
    with pytest.raises(AnalysisException):
        scan_raw(spark, f"{workdir}/no/such/file.csv")


def _zone(workdir, env="pdn"):
    return Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/curated", env=env)


def test_empty_batch_writes_nothing(spark, workdir):
    zone = _zone(workdir, env="emptytest")
    b = BatchDate("20231204")
    write_text(f"{zone.raw_day_path(TRANSACTIONS, b)}/part-0.csv", HEADER)
    result = curate(spark, TRANSACTIONS, b, zone)
    assert result.rows == 0 and result.table is None
    assert scan_curated(spark, zone.curated_path(TRANSACTIONS), TRANSACTIONS).count() == 0


def test_curate_legacy_file_and_rerun(spark, workdir):
    zone = _zone(workdir, env="reruntest")
    b1, b2 = BatchDate("20231204"), BatchDate("20231205")
    for b in (b1, b2):
        write_text(zone.legacy_raw_file(TRANSACTIONS, b),
                   HEADER + "venta;p 1;10;1500.5;hidroelectrica\nventa;p 2;1;;solar\n")
    for b in (b1, b2):
        curate(spark, TRANSACTIONS, b, zone, raw_path=zone.legacy_raw_file(TRANSACTIONS, b))
    path = zone.curated_path(TRANSACTIONS)

    def per_day():
        df = scan_curated(spark, path, TRANSACTIONS)
        return {r.day: r["count"] for r in df.groupBy("day").count().collect()}

    assert per_day() == {"04": 2, "05": 2}
    curate(spark, TRANSACTIONS, b1, zone, raw_path=zone.legacy_raw_file(TRANSACTIONS, b1))
    assert per_day() == {"04": 4, "05": 2}          # append doubles a re-run date
    curate(spark, TRANSACTIONS, b1, zone, rerun="replace",
           raw_path=zone.legacy_raw_file(TRANSACTIONS, b1))
    assert per_day() == {"04": 2, "05": 2}          # replace touches only that date
    legacy = scan_legacy_backfill(spark, zone.raw_root, TRANSACTIONS)
    assert {r.day for r in legacy.select("day").distinct().collect()} == {"04", "05"}
    parts = [r.partition for r in spark.sql(f"SHOW PARTITIONS {zone.table_name(TRANSACTIONS)}")
             .collect()]
    assert sorted(parts) == ["year=2023/month=12/day=04", "year=2023/month=12/day=05"]
    q = hydro_sales(spark.table(zone.table_name(TRANSACTIONS))).collect()
    assert [tuple(r) for r in q] == [("venta", "P 1", 10, 1500, "hidroelectrica")] * 2


def test_backfill_range_prunes_folders(spark, workdir):
    zone = _zone(workdir, env="rangetest")
    for d in ("20240101", "20240102", "20240103"):
        b = BatchDate(d)
        write_text(f"{zone.raw_day_path(PROVIDERS, b)}/part-0.csv",
                   f"nombre_proveedor;tipo_energia\nprov {d};solar\n")
    df = scan_raw_backfill(spark, zone, PROVIDERS, BatchDate("20240102"), BatchDate("20240103"))
    assert sorted(r.day for r in df.collect()) == ["02", "03"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "20240102" in plan
    result = curate_backfill(spark, PROVIDERS, zone, "20240102", "20240103")
    assert result.rows == 2
    out = scan_curated(spark, zone.curated_path(PROVIDERS), PROVIDERS).collect()
    assert sorted((r.nombre_proveedor, r.day) for r in out) == [("PROV 20240102", "02"),
                                                              ("PROV 20240103", "03")]


def test_range_lists_only_its_folders(spark, workdir):
    from jornada.sources.raw import date_cover
    assert date_cover(BatchDate("20231230"), BatchDate("20250202")) == [
        ("2023", "12", "30"), ("2023", "12", "31"), ("2024",), ("2025", "01"), ("2025", "02", "01"), ("2025", "02", "02")]
    zone = _zone(workdir, env="listtest")
    for d in ("20231231", "20240102", "20240103"):
        write_text(f"{zone.raw_day_path(PROVIDERS, BatchDate(d))}/part-0.csv", f"nombre_proveedor;tipo_energia\np;solar\n")
        write_text(zone.legacy_raw_file(PROVIDERS, BatchDate(d)).replace("Providers/", "Providers-files/", 1),
                   "nombre_proveedor;tipo_energia\np;solar\n")
    for first, last, n in (("20240102", "20240102", 1), ("20240101", "20240131", 2), ("20230101", "20241231", 3),
                           ("20250101", "20250101", 0)):
        df = scan_raw_backfill(spark, zone, PROVIDERS, BatchDate(first), BatchDate(last))
        assert len(df.inputFiles()) == n and df.count() == n, (first, last)


def test_backfill_of_one_file_a_day_registers_its_dates(spark, workdir, monkeypatch):
    from jornada.__main__ import main
    zone = _zone(workdir, env="filesback")
    for d in ("20231231", "20240102", "20240103"):
        write_text(zone.legacy_raw_file(PROVIDERS, BatchDate(d)), f"nombre_proveedor;tipo_energia\np{d};solar\n")
    write_text(zone.legacy_raw_file(PROVIDERS, BatchDate("20240103")).replace(".csv", "_v2.csv"),
               "nombre_proveedor;tipo_energia\nsecond;solar\n")
    real, said = type(spark).sql, []
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: said.append(q) or real(self, q, *a, **k))
    assert main(["backfill", "--dataset", "Providers", "--start", "20240101", "--end", "20240131", "--raw-layout", "files",
                 "--raw-root", zone.raw_root, "--curated-root", zone.curated_root, "--env", "filesback"]) == 0
    rows = spark.table(zone.table_name(PROVIDERS)).select("nombre_proveedor", "day").collect()
    assert sorted(map(tuple, rows)) == [("P20240102", "02"), ("P20240103", "03")]
    assert not any("RECOVER" in q for q in said) and any("ADD IF NOT EXISTS" in q for q in said)
    assert main(["backfill", "--start", "2024"]) == 1


def test_sync_catalog_add_partition(spark, workdir):
    zone = _zone(workdir, env="synctest")
    b = BatchDate("20231204")
    write_text(f"{zone.raw_day_path(CUSTOMERS, b)}/part-0.csv",
               "tipo_identificacion;identificacion;nombre;ciudad\nCC;1;ana;cali\n")
    curate(spark, CUSTOMERS, b, zone, sync=False)
    name = sync_catalog(spark, zone.database, CUSTOMERS, zone.curated_path(CUSTOMERS), [b])
    row = spark.table(name).first()
    assert (row.nombre, row.year, row.month, row.day) == ("ANA", "2023", "12", "04")
    types = dict(spark.table(name).dtypes)
    assert types["month"] == "string"


def test_write_failure_names_dataset_and_date(spark, workdir):
    zone = _zone(workdir, env="failtest")
    b = BatchDate("20231204")
    write_text(f"{zone.raw_day_path(PROVIDERS, b)}/part-0.csv",
               "nombre_proveedor;tipo_energia\nacme;solar\n")
    # No Hudi jar in this environment: the format cannot be found.
    with pytest.raises(RuntimeError, match="Providers for 20231204"):
        curate(spark, PROVIDERS, b, zone, fmt="hudi")


def test_sync_catalog_refuses_other_location(spark, workdir):
    zone = _zone(workdir, env="locationtest")
    b = BatchDate("20231204")
    write_text(f"{zone.raw_day_path(PROVIDERS, b)}/part-0.csv",
               "nombre_proveedor;tipo_energia\nacme;solar\n")
    result = curate(spark, PROVIDERS, b, zone)
    assert result.table is not None
    with pytest.raises(ValueError, match="registered at"):
        sync_catalog(spark, zone.database, PROVIDERS, f"{workdir}/elsewhere", [b])


def test_reordered_raw_header_fails_loudly(spark, workdir):
    zone = _zone(workdir, env="headertest")
    b = BatchDate("20231204")
    write_text(f"{zone.raw_day_path(PROVIDERS, b)}/part-0.csv",
               "tipo_energia;nombre_proveedor\nsolar;acme\n")
    with pytest.raises(RuntimeError):
        curate(spark, PROVIDERS, b, zone)


def test_header_inferred_scan_checks_every_file(spark, workdir):
    a = write_text(f"{workdir}/h/a.csv", "nombre_proveedor;tipo_energia\nacme;solar\n")
    b = write_text(f"{workdir}/h/b.csv", "tipo_energia;nombre_proveedor\nsolar;beta\n")
    assert scan_raw(spark, a).collect()[0].nombre_proveedor == "acme"
    with pytest.raises(Exception, match="(?i)header"):
        scan_raw(spark, [a, b]).collect()


def test_replacing_a_date_with_an_empty_batch_clears_it(spark, workdir):
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur", env="cleartest")
    header = "nombre_proveedor;tipo_energia\n"
    days = [BatchDate("20240101"), BatchDate("20240102")]
    for b in days:
        write_text(f"{zone.raw_day_path(PROVIDERS, b)}/part.csv", header + "a;solar\n")
        curate(spark, PROVIDERS, b, zone)
    write_text(f"{zone.raw_day_path(PROVIDERS, days[0])}/part.csv", header)
    assert curate(spark, PROVIDERS, days[0], zone).rows == 0
    per_day = lambda: {r.day: r["count"] for r in scan_curated(
        spark, zone.curated_path(PROVIDERS), PROVIDERS).groupBy("day").count().collect()}
    assert per_day() == {"01": 1, "02": 1}          # append: an empty batch writes nothing
    assert curate(spark, PROVIDERS, days[0], zone, rerun="replace").rows == 0
    assert per_day() == {"02": 1}
