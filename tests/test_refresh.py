"""Refreshes read what changed, survive being lost, and end where a full build ends."""

import pytest
from pyspark.sql import functions as F

from panelkit.plans import landing, refresh
from panelkit.plans.landing_queries import _corrected, _land_all
from panelkit.plans.queries import PARAMS
from panelkit.sinks import record


def cells(df):
    names = sorted(df.columns)
    return sorted(map(str, (tuple(r[n] for n in names) for r in df.collect())))


@pytest.fixture()
def landed(spark, folder, tmp_path):
    rows, files = _land_all(spark, folder, str(tmp_path))
    return rows, files, str(tmp_path)


def test_refresh_equals_a_full_build(spark, landed, monkeypatch):
    rows, files, place = landed
    store, fresh = f"{place}/store", f"{place}/fresh"
    first = refresh.refresh(spark, store, *files, PARAMS)
    assert len(first.read) == 7 and not first.gone
    assert refresh.refresh(spark, store, *files, PARAMS) == refresh.Refreshed([], [], [])

    landing.land_tracker_by_year(_corrected(rows), f"{place}/tracker")
    before = cells(refresh.current_panel(spark, store))
    real = record.add_change

    def lost(*args, **kwargs):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(record, "add_change", lost)
    with pytest.raises(RuntimeError):
        refresh.refresh(spark, store, *files, PARAMS)
    monkeypatch.setattr(record, "add_change", real)
    assert cells(refresh.current_panel(spark, store)) == before

    opened = []
    read = refresh.read_tracker
    monkeypatch.setattr(refresh, "read_tracker", lambda s, paths, **k: opened.extend(paths) or read(s, paths, **k))
    done = refresh.refresh(spark, store, *files, PARAMS)
    assert len(opened) == 1 and "ending=1998" in opened[0]
    assert {m.year for m in done.months} == {1998}
    after = cells(refresh.current_panel(spark, store))
    assert after != before
    refresh.refresh(spark, fresh, *files, PARAMS)
    assert after == cells(refresh.current_panel(spark, fresh))


def test_a_withdrawn_file_and_a_new_index(spark, folder, landed):
    rows, files, place = landed
    store = f"{place}/store"
    refresh.refresh(spark, store, *files, PARAMS)
    from panelkit.staging import file_system

    system, year = file_system(spark, f"{place}/tracker/ending=1997")
    system.delete(year, True)
    done = refresh.refresh(spark, store, *files, PARAMS)
    assert not done.read and len(done.gone) == 1 and {m.year for m in done.months} == {1997}
    panel = refresh.current_panel(spark, store)
    assert panel.filter(F.year("month") == 1997).isEmpty() and not panel.filter(F.year("month") == 1998).isEmpty()

    from panelkit.sources import bind

    bind.index_wide(spark, folder).limit(0 + 5).write.mode("overwrite").csv(f"{place}/index", header=True)
    done = refresh.refresh(spark, store, *files, PARAMS)
    assert not done.read and len(done.months) > 40
    assert refresh.current_panel(spark, store).select("zip").distinct().count() <= 5


def test_an_overtaken_refresh_is_refused(spark, landed, monkeypatch):
    _, files, place = landed
    store = f"{place}/store"
    real = refresh.read_series

    def meanwhile(s, paths):
        monkeypatch.setattr(refresh, "read_series", real)
        refresh.refresh(s, store, *files, PARAMS)
        return real(s, paths)

    monkeypatch.setattr(refresh, "read_series", meanwhile)
    with pytest.raises(record.Outrun):
        refresh.refresh(spark, store, *files, PARAMS)
    assert record.last_number(spark, store) == 1
