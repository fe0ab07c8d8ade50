from conftest import write_text
from jornada.__main__ import main
from jornada.config import BatchDate, Zone
from jornada.spec import PROVIDERS


def test_bad_date_exits_1(capsys):
    assert main(["curate", "--process-date", "2023124"]) == 1
    assert main(["curate"]) == 1
    assert "yyyyMMdd" in capsys.readouterr().err


def test_land_then_curate_then_query(spark, workdir, capsys):
    drop = f"{workdir}/drop"
    write_text(f"{drop}/Providers_20231204.csv", "nombre_proveedor;tipo_energia\nacme;solar\n")
    write_text(f"{drop}/Transactions_20231204.csv",
               "tipo_transaccion;nombre;cantidad_comprada;precio;tipo_energia\n"
               "venta;p 1;3;1500.9;hidroelectrica\nventa;p 2;3;;hidroelectrica\n")
    common = ["--raw-root", f"{workdir}/raw", "--curated-root", f"{workdir}/cur",
              "--env", "clitest"]
    assert main(["land", "--drop", drop, "--process-date", "20231204", *common]) == 0
    assert '"ok": 2' in capsys.readouterr().out
    # No customers file landed for the day: that dataset fails, the others run.
    assert main(["curate", "--process-date", "20231204", "--dataset", "all", *common]) == 1
    out = capsys.readouterr().out
    assert '"Transactions": {"rows": 2' in out and '"zero_filled_precio": 1' in out
    assert '"Customers": {"error": ' in out and "PATH_NOT_FOUND" in out
    assert main(["query", "--output", f"{workdir}/q", *common]) == 0
    rows = spark.read.parquet(f"{workdir}/q").collect()
    assert [tuple(r) for r in rows] == [("venta", "P 1", 3, 1500, "hidroelectrica")]
    zone = Zone(f"{workdir}/raw", f"{workdir}/cur", "clitest")
    assert spark.table(zone.table_name(PROVIDERS)).where(
        f"day = '{BatchDate('20231204').day}'").count() == 1


def test_missing_job_arguments_exit_2(spark, capsys):
    assert main(["land", "--raw-root", "/nowhere/raw", "--curated-root", "/nowhere/cur"]) == 2
    assert main(["query", "--raw-root", "/nowhere/raw", "--curated-root", "/nowhere/cur"]) == 2
    err = capsys.readouterr().err
    assert "--drop is required" in err and "--output is required" in err


def test_curate_reads_one_file_a_day_layout(spark, workdir, capsys):
    zone = Zone(f"{workdir}/raw", f"{workdir}/cur", "clifiles")
    path = zone.legacy_raw_file(PROVIDERS, BatchDate("20231204"))
    # Columns go by the header line, so their order is free in this layout.
    write_text(path, "tipo_energia;nombre_proveedor\nsolar;acme\n")
    write_text(path.replace(".csv", "_v2.csv"), "tipo_energia;nombre_proveedor\neolica;other\n")
    args = ["curate", "--process-date", "20231204", "--dataset", "Providers", "--raw-layout", "files",
            "--raw-root", zone.raw_root, "--curated-root", zone.curated_root, "--env", "clifiles"]
    assert main(args) == 0
    assert '"rows": 1' in capsys.readouterr().out
    rows = spark.table(zone.table_name(PROVIDERS)).select("nombre_proveedor", "tipo_energia").collect()
    assert [tuple(r) for r in rows] == [("ACME", "solar")]
