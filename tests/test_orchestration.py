"""Job wiring, in the manner of the reference's own test: each step is called
once, in order, with the previous step's output."""

from jornada.config import BatchDate, Zone
from jornada.plans import jobs
from jornada.spec import PROVIDERS


def test_curate_calls_scan_transform_write_sync_once(monkeypatch):
    calls = []
    raw = object()

    class Frame:
        columns = list(PROVIDERS.columns)
    curated = Frame()

    class FakeObservation:
        def __init__(self, name):
            self.get = {"rows": 3}

    monkeypatch.setattr(jobs, "Observation", FakeObservation)
    monkeypatch.setattr(jobs, "scan_raw_day",
                        lambda spark, zone, spec, batch: calls.append(("scan", spec, batch)) or raw)

    def fake_curate(df, spec, batch, observation):
        calls.append(("curate", df is raw))
        return curated
    monkeypatch.setattr(jobs, "curate_frame", fake_curate)
    monkeypatch.setattr(jobs, "write_batch",
                        lambda df, path, fmt, rerun, options: calls.append(("write", df is curated,
                                                                            rerun)))
    monkeypatch.setattr(jobs, "sync_catalog",
                        lambda spark, db, spec, path, batches: calls.append(("sync", db, batches))
                        or "t")
    zone = Zone("raw", "cur", env="qa")
    result = jobs.curate(None, PROVIDERS, "20231204", zone)
    b = BatchDate("20231204")
    assert calls == [("scan", PROVIDERS, b), ("curate", True), ("write", True, "append"),
                     ("sync", "co_energy_marketer_curated_qc_rl", [b])]
    assert result.rows == 3 and result.table == "t"


def test_empty_batch_skips_catalog(monkeypatch):
    class Empty:
        def __init__(self, name):
            self.get = {"rows": 0}

    monkeypatch.setattr(jobs, "Observation", Empty)
    monkeypatch.setattr(jobs, "scan_raw_day", lambda *a: object())
    monkeypatch.setattr(jobs, "curate_frame", lambda *a, **k: object())
    monkeypatch.setattr(jobs, "write_batch", lambda *a, **k: None)

    def no_sync(*a, **k):
        raise AssertionError("catalog must not be touched for an empty batch")
    monkeypatch.setattr(jobs, "sync_catalog", no_sync)
    result = jobs.curate(None, PROVIDERS, "20231204", Zone("raw", "cur"))
    assert result.rows == 0 and result.table is None
