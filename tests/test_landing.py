import pytest
from pyspark.sql import functions as F

from conftest import write_text
from jornada.config import BatchDate, Zone
from jornada.operators.landing import (OK, REJECTED_DATASET, REJECTED_MALFORMED, REJECTED_NAME,
                                       dataset_token, date_token, parse_batch_date)
from jornada.plans import curate_backfill, land_drop
from jornada.sources import scan_raw_backfill, scan_raw_day
from jornada.sources.manifest import has_manifest
from jornada.spec import PROVIDERS

NAMES = {
    "Providers_20231204.csv": ("Providers", "2023-12-04"),
    "Providers_20231204_v2.csv": ("Providers", "2023-12-04"),
    "bad.csv": ("bad.csv", None),
    "Providers_20231304.csv": ("Providers", None),
    "Providers_20230229.csv": ("Providers", None),
    "Providers_2023124.csv": ("Providers", None),   # seven digits: rejected here
    "Providers_20240229.csv": ("Providers", "2024-02-29"),
}


def test_name_parsing(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "object string")
    out = df.select("object", dataset_token(F.col("object")).alias("ds"),
                    F.date_format(parse_batch_date(date_token(F.col("object"))), "yyyy-MM-dd")
                    .alias("d")).collect()
    assert {r.object: (r.ds, r.d) for r in out} == NAMES


def test_land_drop_end_to_end(spark, workdir):
    drop = f"{workdir}/drop"
    prov = "nombre_proveedor;tipo_energia\nacme;solar\nbeta;eolica\n"
    write_text(f"{drop}/Providers_20231204.csv", prov)
    write_text(f"{drop}/Providers_20231205.csv", prov + "gamma;solar;extra\n")
    write_text(f"{drop}/Providers_20231206.csv", prov + "delta\n")
    write_text(f"{drop}/Providers_2023124.csv", prov)
    write_text(f"{drop}/Ventas_20231204.csv", prov)
    write_text(f"{drop}/Customers_20231204.csv",
               "tipo_identificacion;identificacion;nombre;ciudad\n")   # header only
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    report = {r.object: r for r in land_drop(spark, drop, zone).collect()}
    assert report["Providers_20231204.csv"].status == OK
    assert report["Providers_20231205.csv"].status == REJECTED_MALFORMED
    assert report["Providers_20231205.csv"].long_rows == 1
    assert report["Providers_20231206.csv"].status == OK
    assert report["Providers_20231206.csv"].short_rows == 1
    assert report["Providers_2023124.csv"].status == REJECTED_NAME
    assert report["Ventas_20231204.csv"].status == REJECTED_DATASET
    assert report["Customers_20231204.csv"].rows == 0
    assert report["Providers_20231204.csv"].destination == (
        "Providers/year=2023/month=12/day=04/object=Providers_20231204.csv")
    landed = scan_raw_backfill(spark, zone, PROVIDERS)
    counts = {r.day: r["count"] for r in landed.groupBy("day").count().collect()}
    assert counts == {"04": 2, "06": 3}
    short = landed.where(F.col("nombre_proveedor") == "delta").first()
    assert short.tipo_energia is None
    # Landing the same drop again replaces the landed days instead of doubling them.
    land_drop(spark, drop, zone)
    counts = {r.day: r["count"] for r in scan_raw_backfill(spark, zone, PROVIDERS)
              .groupBy("day").count().collect()}
    assert counts == {"04": 2, "06": 3}


def test_land_one_batch_date_only(spark, workdir):
    drop = f"{workdir}/drop"
    prov = "nombre_proveedor;tipo_energia\nacme;solar\n"
    write_text(f"{drop}/Providers_20231204.csv", prov)
    write_text(f"{drop}/Providers_20231205.csv", prov)
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    land_drop(spark, drop, zone, batch="20231205")
    days = {r.day for r in scan_raw_backfill(spark, zone, PROVIDERS).collect()}
    assert days == {"05"}


def test_objects_are_read_in_batches(spark, workdir, monkeypatch):
    """The same rows land whatever the number of objects per scan."""
    from jornada.operators import landing
    monkeypatch.setattr(landing, "OBJECTS_PER_SCAN", 1)
    drop = f"{workdir}/drop"
    prov = "nombre_proveedor;tipo_energia\nacme;solar\n"
    write_text(f"{drop}/Providers_20231204.csv", prov)
    write_text(f"{drop}/Providers_20231205.csv", prov + "x;y;z\n")
    write_text(f"{drop}/Providers_20231206.csv", prov)
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    land_drop(spark, drop, zone)
    days = sorted(r.day for r in scan_raw_backfill(spark, zone, PROVIDERS).collect())
    assert days == ["04", "06"]


def objects_of(spark, zone, spec=PROVIDERS):
    df = scan_raw_backfill(spark, zone, spec, every_object=True)
    return {r.object: r["count"] for r in df.groupBy("object").count().collect()}


def test_second_object_of_a_day_is_kept_beside_the_first(spark, workdir):
    prov = "nombre_proveedor;tipo_energia\n"
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    write_text(f"{workdir}/a/Providers_20231204.csv", prov + "acme;solar\nbeta;eolica\n")
    write_text(f"{workdir}/b/Providers_20231204_v2.csv", prov + "other;solar\n")
    land_drop(spark, f"{workdir}/a", zone)
    assert [r.status for r in land_drop(spark, f"{workdir}/b", zone).collect()] == [OK]
    assert objects_of(spark, zone) == {"Providers_20231204.csv": 2, "Providers_20231204_v2.csv": 1}
    # Curation and backfills read the day's own file.
    assert scan_raw_day(spark, zone, PROVIDERS, BatchDate("20231204")).count() == 2
    assert scan_raw_backfill(spark, zone, PROVIDERS).count() == 2
    with pytest.raises(FileNotFoundError, match="PATH_NOT_FOUND"):
        scan_raw_day(spark, zone, PROVIDERS, BatchDate("20231205"))


def test_object_landed_again_replaces_only_itself(spark, workdir):
    prov = "nombre_proveedor;tipo_energia\n"
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur", env="againtest")
    for drop, body in (("a", "acme;solar\nbeta;eolica\n"), ("b", "")):
        write_text(f"{workdir}/{drop}/Providers_20231204.csv", prov + body)
        write_text(f"{workdir}/{drop}/Providers_20231205.csv", prov + "gamma;solar\n")
        land_drop(spark, f"{workdir}/{drop}", zone)
        curate_backfill(spark, PROVIDERS, zone, "20231201", "20231231", rerun="replace")
    assert objects_of(spark, zone) == {"Providers_20231205.csv": 1}
    table = spark.table(zone.table_name(PROVIDERS))
    assert [(r.day, r["count"]) for r in table.groupBy("day").count().collect()] == [("05", 1)]


def test_failed_write_leaves_no_claim_and_a_retry_lands(spark, workdir, monkeypatch):
    from jornada.operators import landing
    prov = "nombre_proveedor;tipo_energia\n"
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    write_text(f"{workdir}/a/Providers_20231204.csv", prov + "acme;solar\n")
    write_text(f"{workdir}/b/Providers_20231204.csv", prov + "acme;solar\nbeta;solar\n")
    land_drop(spark, f"{workdir}/a", zone)
    real = landing.write_objects

    def half(rows, *args):
        real(rows.limit(1), *args)  # data arrive, but not whole
        raise OSError("disk full")
    monkeypatch.setattr(landing, "write_objects", half)
    with pytest.raises(RuntimeError, match="Providers"):
        land_drop(spark, f"{workdir}/b", zone)
    assert objects_of(spark, zone) == {"Providers_20231204.csv": 1}
    logs = spark.read.parquet(f"{zone.raw_root}/_landing/*").groupBy("status").count().collect()
    assert {r.status: r["count"] for r in logs} == {OK: 1, "failed_write": 1}
    monkeypatch.setattr(landing, "write_objects", real)
    land_drop(spark, f"{workdir}/b", zone)
    assert objects_of(spark, zone) == {"Providers_20231204.csv": 2}


def test_rows_lost_between_count_and_write_are_an_error(spark, workdir, monkeypatch):
    from jornada.operators import landing
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    write_text(f"{workdir}/a/Providers_20231204.csv", "nombre_proveedor;tipo_energia\nacme;solar\nb;solar\n")
    real = landing.read_objects
    monkeypatch.setattr(landing, "read_objects", lambda spark, drop, names, columns, malformed=False:
                        real(spark, drop, names, columns, malformed).where(
                            F.lit(malformed) | (F.col("nombre_proveedor") != "b")))
    with pytest.raises(RuntimeError, match="Providers"):
        land_drop(spark, f"{workdir}/a", zone)
    assert scan_raw_backfill is not None and not has_manifest(spark, zone, PROVIDERS)


def test_columns_go_by_name_and_further_ones_pass(spark, workdir):
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur", env="nametest")
    drop = f"{workdir}/drop"
    write_text(f"{drop}/Providers_20231201.csv", "tipo_energia;Nombre_Proveedor\nsolar;acme\n")
    write_text(f"{drop}/Providers_20231202.csv", "nombre_proveedor;Region o.k.;tipo_energia\nbeta;sur;eolica\n")
    for i, bad in enumerate(("nombre_proveedor;otra", "nombre_proveedor;tipo_energia;day", "nombre_proveedor;tipo_energia;",
                             "nombre_proveedor;tipo_energia;TIPO_ENERGIA")):
        write_text(f"{drop}/Providers_2023121{i}.csv", bad + "\na;b;c;d\n")
    write_text(f"{drop}/Providers_20231215.csv", "x;y\nnombre_proveedor;tipo_energia\n")
    report = {r.object: r.status for r in land_drop(spark, drop, zone).collect()}
    assert [report.pop(f"Providers_2023120{i}.csv") for i in (1, 2)] == [OK, OK]
    assert len(report) == 5 and set(report.values()) == {"rejected_header"}
    rows = scan_raw_backfill(spark, zone, PROVIDERS)
    assert rows.columns == ["tipo_energia", "nombre_proveedor", "Region o.k.", "year", "month", "day"]
    curate_backfill(spark, PROVIDERS, zone)
    got = spark.table(zone.table_name(PROVIDERS)).select("nombre_proveedor", "tipo_energia", "`Region o.k.`", "day")
    assert sorted(map(tuple, got.collect())) == [("ACME", "solar", None, "01"), ("BETA", "eolica", "sur", "02")]


def test_rows_are_counted_by_the_parser_that_reads_them(spark, workdir):
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    drop, head = f"{workdir}/drop", "nombre_proveedor;tipo_energia\n"
    write_text(f"{drop}/Providers_20231201.csv", head + 'TUBO 5";solar\na \\" b;solar\n   \n"x;y";eolica\n')
    write_text(f"{drop}/Providers_20231202.csv", head + 'TUBO 5";EXTRA;X 6"\nok;solar\n')
    write_text(f"{drop}/Providers_20231203.csv", head + "a;b;;\nshort\n")
    report = {r.object[-6:-4]: (r.rows, r.long_rows, r.short_rows, r.status)
              for r in land_drop(spark, drop, zone).collect()}
    assert report == {"01": (3, 0, 0, OK), "02": (2, 1, 0, REJECTED_MALFORMED), "03": (2, 1, 1, REJECTED_MALFORMED)}
    rows = scan_raw_backfill(spark, zone, PROVIDERS).select(*PROVIDERS.columns).collect()
    assert {tuple(r) for r in rows} == {('TUBO 5"', "solar"), ('a \\" b', "solar"), ("x;y", "eolica")}


def test_rejected_objects_are_kept_with_the_reason(spark, workdir):
    from jornada.operators.landing import scan_quarantine
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    drop = f"{workdir}/drop"
    write_text(f"{drop}/bad.csv", "a;b\n1;2\n")
    write_text(f"{drop}/Providers_20231204.csv", "")
    write_text(f"{drop}/Providers_20231205.csv", "nombre_proveedor;tipo_energia\na;b;c\n")
    land_drop(spark, drop, zone)
    kept = {r.object: (r.status, r.bytes) for r in scan_quarantine(spark, zone).collect()}
    assert kept == {"bad.csv": (REJECTED_NAME, 8), "Providers_20231204.csv": ("rejected_empty", 0),
                    "Providers_20231205.csv": (REJECTED_MALFORMED, 36)}
    lines = spark.read.text(f"{zone.raw_root}/_quarantine/*/lines/*").select("value", "object").collect()
    assert sorted(r.value for r in lines if r.object == "bad.csv") == ["1;2", "a;b"] and len(lines) == 4


def test_an_object_that_cannot_be_read_stops_no_other(spark, workdir):
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    drop, head = f"{workdir}/drop", "nombre_proveedor;tipo_energia\na;solar\n"
    for d in (1, 2, 4):
        write_text(f"{drop}/Providers_2023120{d}.csv", head)
    write_text(f"{drop}/Providers_20231203.csv.gz", "not gzip at all")
    report = {r.object: r.status for r in land_drop(spark, drop, zone).collect()}
    assert report.pop("Providers_20231203.csv.gz") == "rejected_unreadable" and set(report.values()) == {OK}
    assert scan_raw_backfill(spark, zone, PROVIDERS).count() == 3


def test_only_objects_of_the_date_are_scanned(spark, workdir, monkeypatch):
    from jornada.operators import landing
    seen = set()
    real = landing._paths

    def paths(drop_dir, objects):
        seen.update(objects)
        return real(drop_dir, objects)
    monkeypatch.setattr(landing, "_paths", paths)
    for d in ("01", "02", "03"):
        write_text(f"{workdir}/drop/Providers_202312{d}.csv", "nombre_proveedor;tipo_energia\na;solar\n")
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    report = land_drop(spark, f"{workdir}/drop", zone, batch="20231202").collect()
    assert sorted(r.status for r in report) == [OK, "skipped_other_date", "skipped_other_date"]
    assert seen == {"Providers_20231202.csv"}
    # Reading the day lists its one object's folder.
    files = scan_raw_day(spark, zone, PROVIDERS, BatchDate("20231202")).inputFiles()
    assert len(files) == 1 and "/object=Providers_20231202.csv/landing=" in files[0]


def test_date_rule_agrees_with_strptime(spark):
    """L1 on thousands of random tokens: Spark's rule equals Python's parser
    restricted to exactly eight digits."""
    import datetime as dt
    import random
    rng = random.Random(11)
    tokens = [f"{rng.randint(1900, 2100):04d}{rng.randint(0, 13):02d}{rng.randint(0, 32):02d}"
              for _ in range(4000)]
    tokens += ["2023124", "202312041", "2023-1204", "", "abcdefgh", "20240229", "21000229"]

    def expected(tok):
        if len(tok) != 8 or not tok.isdigit():
            return None
        try:
            return dt.datetime.strptime(tok, "%Y%m%d").date()
        except ValueError:
            return None

    df = spark.createDataFrame([(i, f"Providers_{t}.csv") for i, t in enumerate(tokens)],
                               "i int, object string")
    got = [r.d for r in df.orderBy("i").select(
        parse_batch_date(date_token(F.col("object"))).alias("d")).collect()]
    assert got == [expected(t) for t in tokens]


def test_gzip_objects_land(spark, workdir):
    import gzip
    import os
    drop = f"{workdir}/drop"
    os.makedirs(drop.replace("file:", ""), exist_ok=True)
    with gzip.open(f"{drop}/Providers_20231204.csv.gz".replace("file:", ""), "wt") as fh:
        fh.write("nombre_proveedor;tipo_energia\nacme;solar\nbeta;eolica\n")
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    report = land_drop(spark, drop, zone).collect()
    assert [(r.object, r.status, r.rows) for r in report] == [
        ("Providers_20231204.csv.gz", OK, 2)]
    assert scan_raw_backfill(spark, zone, PROVIDERS, every_object=True).count() == 2


def test_header_must_match_dataset_columns(spark, workdir):
    from jornada.operators.landing import REJECTED_HEADER
    drop = f"{workdir}/drop"
    body = "acme;solar\nbeta;eolica\n"
    write_text(f"{drop}/Providers_20231201.csv", "tipo_energia;nombre_proveedor\n" + body)
    write_text(f"{drop}/Providers_20231202.csv", "proveedor;energia\n" + body)
    write_text(f"{drop}/Providers_20231203.csv", '\ufeff"Nombre_Proveedor";"TIPO_ENERGIA"\n' + body)
    write_text(f"{drop}/Providers_20231204.csv", "nombre_proveedor;tipo_energia\n" + body)
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    report = {r.object: r.status for r in land_drop(spark, drop, zone).collect()}
    assert report == {"Providers_20231201.csv": OK,
                      "Providers_20231202.csv": REJECTED_HEADER,
                      "Providers_20231203.csv": OK, "Providers_20231204.csv": OK}
    days = sorted(r.day for r in scan_raw_backfill(spark, zone, PROVIDERS).collect())
    assert days == ["01", "01", "03", "03", "04", "04"]


def test_header_found_when_a_file_spans_many_splits(spark, workdir):
    from jornada.operators.landing import header_lines, quality
    drop = f"{workdir}/drop"
    rows = "".join(f"prov {i};solar\n" for i in range(20000))
    write_text(f"{drop}/Providers_20231204.csv", "nombre_proveedor;tipo_energia\n" + rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        lines = spark.read.text(f"{drop}/Providers_20231204.csv")
        assert lines.rdd.getNumPartitions() > 5
        name = "Providers_20231204.csv"
        assert [r.header for r in header_lines(spark, drop, [name]).collect()] == ["nombre_proveedor;tipo_energia"]
        q = quality(spark, drop, [name], list(PROVIDERS.columns)).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (q.rows, q.long_rows, q.short_rows) == (20000, 0, 0)


def test_object_names_under_nested_folders_of_the_same_name(spark, workdir):
    from jornada.operators.landing import _path_only
    assert _path_only("file:///tmp/a/drop/") == "/tmp/a/drop"
    assert _path_only("s3a://bucket/x/drop") == "/x/drop"
    assert _path_only("/tmp/a") == "/tmp/a"
    drop = f"{workdir}/drop/inner/drop"
    write_text(f"{drop}/Providers_20231204.csv", "nombre_proveedor;tipo_energia\nacme;solar\n")
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    report = [(r.object, r.status) for r in land_drop(spark, drop, zone).collect()]
    assert report == [("Providers_20231204.csv", OK)]


def test_one_failing_dataset_does_not_stop_the_others(spark, workdir, monkeypatch):
    import pytest
    from jornada.operators import landing
    real = landing.write_objects

    def flaky(rows, zone, spec, landing_id):
        if spec.name == "Customers":
            raise OSError("disk full")
        real(rows, zone, spec, landing_id)
    monkeypatch.setattr(landing, "write_objects", flaky)
    drop = f"{workdir}/drop"
    write_text(f"{drop}/Providers_20231204.csv", "nombre_proveedor;tipo_energia\nacme;solar\n")
    write_text(f"{drop}/Customers_20231204.csv",
               "tipo_identificacion;identificacion;nombre;ciudad\nCC;1;ana;cali\n")
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    with pytest.raises(RuntimeError, match="Customers"):
        land_drop(spark, drop, zone)
    assert scan_raw_backfill(spark, zone, PROVIDERS).count() == 1


def test_object_names_with_glob_characters(spark, workdir):
    from jornada.operators.landing import _glob_escape
    assert _glob_escape("a[1]*{x}?.csv") == r"a\[1\]\*\{x\}\?.csv"
    drop = f"{workdir}/drop"
    prov = "nombre_proveedor;tipo_energia\n"
    write_text(f"{drop}/Providers_20231204_[1].csv", prov + "acme;solar\n")
    write_text(f"{drop}/Providers_20231204_1.csv", prov + "beta;solar\ngamma;solar\n")
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur")
    report = {r.object: (r.status, r.rows) for r in land_drop(spark, drop, zone).collect()}
    assert report == {"Providers_20231204_[1].csv": (OK, 1), "Providers_20231204_1.csv": (OK, 2)}
    assert objects_of(spark, zone) == {"Providers_20231204_[1].csv": 1, "Providers_20231204_1.csv": 2}


def test_blank_file_is_unreadable(spark, workdir):
    from jornada.operators.landing import REJECTED_UNREADABLE, landing_report
    drop = f"{workdir}/drop"
    write_text(f"{drop}/Providers_20231204.csv", "\n\n\n")
    write_text(f"{drop}/Providers_20231205.csv", "")
    report = {r.object: r.status for r in landing_report(spark, drop).collect()}
    assert report == {"Providers_20231204.csv": REJECTED_UNREADABLE, "Providers_20231205.csv": "rejected_empty"}
