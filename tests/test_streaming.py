import pytest

from conftest import write_text
from jornada.config import BatchDate, Zone
from jornada.sources import scan_curated
from jornada.spec import PROVIDERS
from jornada.streaming import curate_days, curate_stream

HEADER = "nombre_proveedor;tipo_energia\n"


def _land(zone, day, body):
    b = BatchDate(day)
    write_text(f"{zone.raw_day_path(PROVIDERS, b)}/part-{day}.csv", HEADER + body)


def _per_day(spark, zone):
    df = scan_curated(spark, zone.curated_path(PROVIDERS), PROVIDERS)
    return {r.day: r["count"] for r in df.groupBy("day").count().collect()}


def test_stream_picks_up_new_days_only(spark, workdir):
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur", env="streamtest")
    _land(zone, "20240101", "a;solar\nb;eolica\n")
    curate_stream(spark, PROVIDERS, zone).awaitTermination()
    assert _per_day(spark, zone) == {"01": 2}
    _land(zone, "20240102", "c;solar\n")
    q = curate_stream(spark, PROVIDERS, zone)
    q.awaitTermination()
    assert _per_day(spark, zone) == {"01": 2, "02": 1}
    names = {r.nombre_proveedor for r in scan_curated(spark, zone.curated_path(PROVIDERS),
                                                      PROVIDERS).collect()}
    assert names == {"A", "B", "C"}
    # Nothing new: a further run changes nothing.
    curate_stream(spark, PROVIDERS, zone).awaitTermination()
    assert _per_day(spark, zone) == {"01": 2, "02": 1}


def test_batches_report_their_days_and_counts(spark, workdir):
    from jornada.plans import land_drop
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur", env="metrictest")
    batches = []
    for i, body in enumerate(("a;solar\nb;solar\n", "")):
        write_text(f"{workdir}/{i}/Providers_20240101.csv", HEADER + body)
        land_drop(spark, f"{workdir}/{i}", zone)
        curate_stream(spark, PROVIDERS, zone, on_batch=batches.append).awaitTermination()
    # Landed again without rows, the day is emptied.
    assert [([d.text for d in b.days], b.metrics["rows"], [d.text for d in b.cleared]) for b in batches] == [
        (["20240101"], 2, []), (["20240101"], 0, ["20240101"])]
    assert [b.batch_id for b in batches] == [0, 1] and _per_day(spark, zone) == {}


def test_batch_failure_names_dataset_and_days(spark, workdir):
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur", env="streamfail")
    _land(zone, "20240101", "")
    write_text(f"{zone.raw_day_path(PROVIDERS, BatchDate('20240101'))}/part-2.csv", "x;y\n1;2\n")
    with pytest.raises(RuntimeError, match="Providers, batch 7, 1 days from 20240101"):
        curate_days(spark, PROVIDERS, zone, [BatchDate("20240101")], sync=False, batch_id=7)


def test_replaying_days_is_idempotent(spark, workdir):
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur", env="replaytest")
    _land(zone, "20240101", "a;solar\n")
    _land(zone, "20240102", "b;solar\n")
    days = [BatchDate("20240101"), BatchDate("20240102")]
    curate_days(spark, PROVIDERS, zone, days, sync=False)
    curate_days(spark, PROVIDERS, zone, days[:1], sync=False)
    assert _per_day(spark, zone) == {"01": 1, "02": 1}


def test_relanded_day_replaces_its_curated_rows(spark, workdir):
    from jornada.plans import land_drop
    zone = Zone(raw_root=f"{workdir}/raw", curated_root=f"{workdir}/cur", env="relandtest")
    drop1, drop2 = f"{workdir}/drop1", f"{workdir}/drop2"
    write_text(f"{drop1}/Providers_20240101.csv", HEADER + "a;solar\nb;solar\n")
    land_drop(spark, drop1, zone)
    curate_stream(spark, PROVIDERS, zone).awaitTermination()
    assert _per_day(spark, zone) == {"01": 2}
    # A corrected file for the same day arrives: landing replaces the raw day,
    # the stream sees new files and re-curates the whole day.
    write_text(f"{drop2}/Providers_20240101.csv", HEADER + "a;solar\nb;solar\nc;eolica\n")
    land_drop(spark, drop2, zone)
    curate_stream(spark, PROVIDERS, zone).awaitTermination()
    assert _per_day(spark, zone) == {"01": 3}
