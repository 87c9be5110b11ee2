"""Footers as a data source."""

from __future__ import annotations

import pytest
from pyspark.errors import PythonException

from milepost.sources.footer_source import FooterReader, read_footers
from tests.drift_files import write_drift_set


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return write_drift_set(tmp_path_factory.mktemp("raw"))


def test_a_row_per_file(spark, root):
    rows = {r.relativa: r for r in read_footers(spark, str(root)).collect()}
    assert len(rows) == 7 and all(r.valido and r.error is None and r.bytes > 0 for r in rows.values())
    row = rows["yellow/2025/yellow_tripdata_2025-01.parquet"]
    assert row.registros == 5 and ("passenger_count", "double") in [(c.columna, c.tipo) for c in row.columnas]
    assert [c.posicion for c in row.columnas] == list(range(len(row.columnas)))


def test_files_ruled_out_by_name_are_not_opened(spark, root, tmp_path):
    target = tmp_path / "raw"
    for path in root.rglob("*.parquet"):
        copy = target / path.relative_to(root)
        copy.parent.mkdir(parents=True, exist_ok=True)
        copy.write_bytes(path.read_bytes())
    locked = target / "yellow" / "2024" / "locked_tripdata_2024-09.parquet"
    locked.symlink_to("/proc/1/mem")
    with pytest.raises(PythonException):
        read_footers(spark, str(target)).where("relativa LIKE '%locked%'").collect()
    found = read_footers(spark, str(target))
    assert found.where("relativa LIKE 'green/%' AND registros > 1").select("registros").collect() == [(7,)]
    assert found.where("relativa IN ('green/2026/green_tripdata_2026-06.parquet')").count() == 1
    assert found.where("relativa LIKE '%2026-07.parquet'").select("registros").collect() == [(2,)]


def test_files_are_dealt_to_tasks(root):
    reader = FooterReader({"path": str(root), "filespertask": "2"})
    assert [len(p.files) for p in reader.partitions()] == [2, 2, 2, 1]


def test_broken_and_empty_files_and_an_empty_folder(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"")
    (tmp_path / "b.parquet").write_bytes(b"PAR1PAR1")
    (tmp_path / "c.parquet.part").write_bytes(b"x")
    rows = {r.relativa: r for r in read_footers(spark, f"file://{tmp_path}").collect()}
    assert {n: (r.valido, r.registros, r.columnas) for n, r in rows.items()} == {
        "a.parquet": (False, None, None), "b.parquet": (True, None, None)
    }
    assert all(r.error for r in rows.values())
    (tmp_path / "none").mkdir()
    assert read_footers(spark, str(tmp_path / "none")).collect() == []
