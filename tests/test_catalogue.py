"""Footers are read once, and again only where files changed."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import PythonException

from milepost.plans.settings import Settings
from milepost.plans.trip_source import FileTrips
from milepost.registry import REPORTS
from milepost.sources import inventory
from milepost.sources.catalogue import FooterCatalogue
from tests.drift_files import write_drift_set, write_month


def test_only_changed_footers_are_opened(spark, tmp_path):
    root, path = write_drift_set(tmp_path / "raw"), str(tmp_path / "catalogue")
    first = FooterCatalogue(spark, str(root), path)
    assert first.refresh() == 7
    assert FooterCatalogue(spark, str(root), path).refresh() == 0 and first.table.versions() == [1]
    write_month(root, "green", 2027, 1, 9)
    changed = write_month(root, "yellow", 2024, 1, 5)
    os.remove(root / "yellow" / "2024" / "yellow_tripdata_2024-02.parquet")
    second = FooterCatalogue(spark, str(root), path)
    assert second.refresh() == 2 and second.table.versions() == [1, 2]
    counts = {r.relativa.rsplit("/", 1)[1]: r.registros for r in second.counts().collect()}
    assert counts["green_tripdata_2027-01.parquet"] == 9 and counts[changed.name] == 5
    assert "yellow_tripdata_2024-02.parquet" not in counts and len(counts) == 7
    assert second.refresh() == 0


def test_a_known_folder_is_read_without_opening_a_footer(spark, tmp_path, monkeypatch):
    root, path = write_drift_set(tmp_path / "raw"), str(tmp_path / "catalogue")
    settings = Settings(years=(2024, 2025), min_trips=1)
    rows = FileTrips(spark, str(root), settings=settings, catalogue=path).trips().count()

    def opened(*_):
        raise AssertionError("a footer is opened")

    monkeypatch.setattr(inventory, "all_footers", opened)
    monkeypatch.setattr("milepost.sources.drift.all_footers", opened)
    again = FileTrips(spark, str(root), settings=settings, catalogue=path)
    monkeypatch.setattr("milepost.sources.catalogue._rows", lambda files: files.sparkSession.createDataFrame([], again.catalogue.table.ddl))
    assert again.trips().count() == rows == 28
    for name in ("q02_cantidad_registros", "q04_esquema_yellow", "q36_parquet_vs_tabla", "q37_cambios_esquema"):
        plan = REPORTS[name](again)._jdf.queryExecution().executedPlan().toString()
        assert "MapInPandas" not in plan
    # Counts are sums over the catalogue: no trip is scanned.
    plan = REPORTS["q17_registros_conjuntos"](again)._jdf.queryExecution().executedPlan().toString()
    assert "tpep_pickup" not in plan and str(root) not in plan and "registros" in plan


def test_a_read_error_ends_the_query(spark, tmp_path, monkeypatch):
    """Only a broken footer sets a file aside; a store that does not answer must not."""
    root = write_drift_set(tmp_path / "raw")
    hidden = root / "yellow" / "2024" / "yellow_tripdata_2024-03.parquet"
    hidden.symlink_to(root / "yellow" / "2024" / "yellow_tripdata_2024-01.parquet")
    listed = inventory.list_files(spark, str(root)).persist()
    assert listed.count() == 8
    hidden.unlink()
    with pytest.raises(PythonException, match="2024-03"):
        inventory.all_footers(listed).collect()
    listed.unpersist()


def test_broken_footers_are_listed(spark, tmp_path):
    write_month(tmp_path, "yellow", 2024, 1, 3)
    folder = tmp_path / "yellow" / "2024"
    (folder / "yellow_tripdata_2024-02.parquet").write_bytes(b"PAR1xxxx")
    (folder / "yellow_tripdata_2024-03.parquet").write_bytes(b"PAR1" + b"\x00" * 40 + b"\x08\x00\x00\x00PAR1")
    catalogue = FooterCatalogue(spark, str(tmp_path))
    assert sorted(r.relativa[-10:] for r in catalogue.rejected().collect()) == ["02.parquet", "03.parquet"]
    assert [r.registros for r in catalogue.counts().collect()] == [3]
    assert FileTrips(spark, str(tmp_path)).trips().count() == 3
