"""Listing, footers, signatures and drift-safe reading of monthly files."""

from __future__ import annotations

import uuid
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from milepost.operators import evolution, explore, validate
from milepost.plans import tables
from milepost.plans.model import VIAJES
from milepost.plans.settings import Settings
from milepost.plans.trip_source import FileTrips
from milepost.registry import REPORTS
from milepost.sources import inventory, storage
from tests.drift_files import write_drift_set, write_month

SETTINGS = Settings(years=(2024, 2025), min_trips=1)


@pytest.fixture(scope="module")
def root(tmp_path_factory) -> Path:
    return write_drift_set(tmp_path_factory.mktemp("raw"))


@pytest.fixture(scope="module")
def source(spark, root) -> FileTrips:
    return FileTrips(spark, str(root), zones_csv=str(root / "zones" / "lookup.csv"), settings=SETTINGS)


def as_tuples(df):
    return [tuple(r) for r in df.collect()]


def test_listing_and_coverage(source):
    assert as_tuples(REPORTS["q01_cantidad_archivos"](source)) == [
        ("green", 1, "06", "06"),
        ("total", 3, "06", "07"),
        ("yellow", 2, "06", "07"),
    ]
    assert as_tuples(REPORTS["q16_archivos_por_anio_tipo"](source)) == [
        (2024, "yellow", 2, 1, 2, 2),
        (2025, "green", 1, 1, 1, 1),
        (2025, "yellow", 1, 1, 1, 1),
    ]
    assert len(as_tuples(REPORTS["q35_cobertura"](source))) == 5


def test_row_counts(source):
    assert sorted(as_tuples(REPORTS["q02_cantidad_registros"](source))) == [
        ("green", 1), ("total", 9), ("yellow", 8)
    ]
    assert as_tuples(REPORTS["q03_registros_por_archivo"](source)) == [
        ("green", "green_tripdata_2026-06.parquet", 1),
        ("yellow", "yellow_tripdata_2026-06.parquet", 6),
        ("yellow", "yellow_tripdata_2026-07.parquet", 2),
    ]
    assert as_tuples(REPORTS["q17_registros_conjuntos"](source)) == [
        (2024, "total", 7), (2024, "yellow", 7), (2025, "green", 7), (2025, "total", 12), (2025, "yellow", 5)
    ]


def test_merged_schema(source):
    schema = {r.column_name: r.column_type for r in explore.esquema(source.footers(), "yellow").collect()}
    assert schema["passenger_count"] == "DOUBLE"
    assert schema["tpep_pickup_datetime"] == "TIMESTAMP"
    assert schema["PULocationID"] == "INTEGER"
    assert schema["request_source"] == "VARCHAR"
    # One column although its case changes.
    assert [n for n in schema if n.lower() == "airport_fee"] == ["Airport_fee"]
    first = explore.esquema(source.footers(), "yellow").first()
    assert first.column_name == "VendorID"
    green = {r.column_name: r.column_type for r in explore.esquema(source.footers(), "green").collect()}
    assert green["RatecodeID"] == "BIGINT" and green["passenger_count"] == "BIGINT"


def test_schema_changes(source):
    rows = as_tuples(REPORTS["q37_cambios_esquema"](source))
    assert ("yellow", "cbd_congestion_fee", 3, 5, "2025-01", "2026-07") in rows
    assert ("yellow", "request_source", 2, 5, "2026-06", "2026-07") in rows
    assert not [r for r in rows if r[1] == "trip_distance"]


def test_normalised_rows(source):
    trips = source.trips()
    assert dict(trips.dtypes) == VIAJES
    assert trips.count() == 28
    rows = trips.orderBy("tipo_taxi", "anio", "mes", "pickup_datetime").collect()
    by_month = {}
    for r in rows:
        by_month.setdefault((r.tipo_taxi, r.anio, r.mes), []).append(r)
    assert {k: len(v) for k, v in by_month.items()} == {
        ("green", 2025, 1): 7, ("green", 2026, 6): 1, ("yellow", 2024, 1): 3, ("yellow", 2024, 2): 4,
        ("yellow", 2025, 1): 5, ("yellow", 2026, 6): 6, ("yellow", 2026, 7): 2,
    }
    assert all(r.duracion_min == 12.0 for r in rows)
    # Missing fee is 0, missing request source is NULL, types follow the contract.
    assert {r.cbd_congestion_fee for r in by_month["yellow", 2024, 1]} == {0.0}
    assert {r.cbd_congestion_fee for r in by_month["yellow", 2025, 1]} == {0.75}
    assert [r.passenger_count for r in by_month["yellow", 2025, 1]] == [1, 2, 3, 1, 2]
    assert {r.request_source for r in by_month["yellow", 2026, 6]} == {"HV0003"}
    assert by_month["green", 2026, 6][0].ratecode_id is None


def test_a_year_filter_skips_files(source):
    """File names prune the scan as folders would."""
    df = source.trips("anio", "fare_amount").where("anio = 2024")
    assert df.count() == 7
    df.collect()

    def files_read(node):
        own = [node.metrics().get("numFiles").get().value()] if "FileSourceScan" in node.getClass().getName() else []
        children = node.children()
        return own + [n for i in range(children.size()) for n in files_read(children.apply(i))]

    assert sum(files_read(df._jdf.queryExecution().executedPlan())) == 2


def test_saved_table_agrees_with_files(source, spark):
    assert source.saved().count() == 28
    rows = as_tuples(REPORTS["q36_parquet_vs_tabla"](source))
    assert len(rows) == 5 and all(r[4] == 0 for r in rows)
    # Only the wanted year is listed, and only the wanted columns are read.
    plan = source.saved().where("anio = 2025").select("fare_amount")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan and "ReadSchema: struct<fare_amount:double>" in plan


def test_published_names(source, spark):
    source.saved()
    tables.publish_views(source.trips(), source.zones())
    assert spark.sql("SELECT count(*) FROM viajes_validos JOIN zonas ON zona_id = destino_id").first()[0] == 28
    name = f"viajes_{uuid.uuid4().hex[:8]}"
    for _ in range(2):  # publishing again replaces the names
        tables.publish_database(spark, name, source.table, source.zones())
    counts = spark.sql(f"SELECT anio, count(*) AS n FROM {name}.viajes_validos GROUP BY anio ORDER BY anio").collect()
    assert [tuple(r) for r in counts] == [(2024, 7), (2025, 12), (2026, 9)]
    assert spark.table(f"{name}.zonas").count() == 4
    plan = spark.sql(f"SELECT fare_amount FROM {name}.viajes WHERE anio = 2025")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(anio" in plan.toString()


def test_one_sided_groups(spark, source):
    table = source.saved().where("anio <> 2024")
    rows = {(r.anio, r.tipo_taxi): r for r in validate.parquet_vs_tabla(source.record_counts(), table).collect()}
    assert rows[2024, "yellow"].registros_tabla is None and rows[2024, "yellow"].diferencia is None
    filled = validate.parquet_vs_tabla(source.record_counts(), table, missing_as_zero=True)
    assert {r.diferencia for r in filled.where("anio = 2024").collect()} == {7}


def test_every_report_runs_on_plain_files(source):
    """The whole catalogue works on a folder of monthly files."""
    for name, report in REPORTS.items():
        rows = report(source).collect()
        assert rows or name in {"a08_hora_pico"}, name


def test_zone_lookup(source):
    assert as_tuples(source.zones().orderBy("zona_id"))[1] == (2, "Bronx", "B", None)
    rows = as_tuples(REPORTS["q31_destino_propina"](source))
    assert [r[:3] for r in rows] == [("mas alta", "C (Bronx)", 16)]


def test_broken_files_and_missing_months(spark, tmp_path):
    for month in (1, 2, 4):
        write_month(tmp_path, "yellow", 2024, month, 1)
    write_month(tmp_path, "green", 2024, 1, 1)
    folder = tmp_path / "yellow" / "2024"
    (folder / "yellow_tripdata_2024-05.parquet").write_bytes(b"PAR1xxxx")
    (folder / "yellow_tripdata_2024-06.parquet").write_bytes(b"")
    (folder / "yellow_tripdata_2024-07.parquet").write_bytes(b"PAR1PAR1")
    (folder / "yellow_tripdata_sin_fecha.parquet").write_bytes(b"not parquet at all")
    status = inventory.monthly_file_status(spark, str(tmp_path))
    valid = {r.archivo: r.valido for r in status.collect()}
    assert valid["yellow_tripdata_2024-04.parquet"] is True
    assert valid["yellow_tripdata_2024-05.parquet"] is False
    assert valid["yellow_tripdata_2024-06.parquet"] is False
    # The signature is all that is checked.
    assert valid["yellow_tripdata_2024-07.parquet"] is True
    assert valid["yellow_tripdata_sin_fecha.parquet"] is False
    months = validate.meses_esperados(status, [2024])
    assert months.count() == 24
    assert as_tuples(validate.resumen_esperados(months)) == [
        ("green", "existente", 1), ("green", "faltante", 11),
        ("yellow", "existente", 4), ("yellow", "faltante", 6), ("yellow", "invalido", 2),
    ]
    files = inventory.monthly_files(spark, str(tmp_path))
    assert {r.anio for r in files.where("archivo LIKE '%sin_fecha%'").collect()} == {None}


def test_folder_names_above_the_root_do_not_matter(spark, tmp_path):
    root = tmp_path / "green_yellow" / "raw"
    write_month(root, "green", 2024, 1, 2)
    (row,) = inventory.monthly_files(spark, str(root)).collect()
    assert (row.tipo_taxi, row.anio, row.mes) == ("green", 2024, 1)


def test_services_sharing_a_folder(spark, tmp_path):
    for service in ("yellow", "green"):
        path = write_month(tmp_path / service, service, 2024, 1, 2)
        target = tmp_path / "todo" / path.name
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(path.read_bytes())
    source = FileTrips(spark, str(tmp_path / "todo"))
    assert sorted((r.tipo_taxi, r["count"]) for r in source.trips().groupBy("tipo_taxi").count().collect()) == [
        ("green", 2), ("yellow", 2)
    ]


def test_decimal_and_part_and_corrupt_files(spark, tmp_path):
    """A decimal column is cast, foreign files are not read, broken ones are set aside and named."""
    path = write_month(tmp_path, "yellow", 2024, 1, 3)
    raw = pq.read_table(path)
    at = raw.schema.get_field_index("fare_amount")
    pq.write_table(raw.set_column(at, "fare_amount", raw["fare_amount"].cast(pa.decimal128(10, 2))), path)
    write_month(tmp_path, "yellow", 2024, 2, 2)
    folder = path.parent
    (folder / "yellow_tripdata_2024-03.parquet.part").write_bytes(b"half a download")
    (folder / "yellow_tripdata_2024-04.parquet").write_bytes(b"PAR1xxxx")
    source = FileTrips(spark, str(tmp_path), settings=Settings(file_year=2024, years=(2024,), min_trips=1))
    rows = source.trips("mes", "fare_amount").collect()
    assert sorted((r.mes, r.fare_amount) for r in rows) == [(1, 10.0)] * 3 + [(2, 10.0)] * 2
    assert [r.relativa for r in source.rejected().collect()] == ["yellow/2024/yellow_tripdata_2024-04.parquet"]
    assert {r.relativa: r.registros for r in source.record_counts().collect()} == {
        "yellow/2024/yellow_tripdata_2024-01.parquet": 3, "yellow/2024/yellow_tripdata_2024-02.parquet": 2
    }
    for name in ("q02_cantidad_registros", "q04_esquema_yellow", "q17_registros_conjuntos", "q37_cambios_esquema"):
        REPORTS[name](source).collect()


def test_a_whole_folder_of_one_type_is_read_as_a_folder_without_foreign_files(spark, tmp_path):
    path = write_month(tmp_path, "green", 2024, 1, 2)
    (path.parent / "green_tripdata_2024-02.parquet.part").write_bytes(b"half a download")
    assert FileTrips(spark, str(tmp_path)).trips().count() == 2


def test_counts_use_no_python(source):
    plan = REPORTS["q03_registros_por_archivo"](source)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_stores_are_opened_without_network():
    from pyarrow import fs

    options = {"fs.s3a.access.key": "k", "fs.s3a.secret.key": "s", "fs.s3a.endpoint": "store.local:9000"}
    system, inner = storage.locate("s3a://bucket/raw/x.parquet", options)
    assert isinstance(system, fs.S3FileSystem) and inner == "bucket/raw/x.parquet"
    assert storage.locate("file:/a/b.parquet", {})[1] == "/a/b.parquet"
    assert storage.locate("/a/b.parquet", {})[1] == "/a/b.parquet"


def test_a_source_with_a_table_reads_it(spark, source, root):
    """Reports prune the saved table's folders; the files are read on request."""
    table = FileTrips(spark, str(root), settings=SETTINGS)
    table.saved()
    for name in ("q39_control_composicion", "q40_demanda_por_tipo_registro"):
        plan = REPORTS[name](table)._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(tipo_taxi" in plan or "PartitionFilters: [isnotnull(anio" in plan
    assert "tripdata" not in str(table.trips().inputFiles()[0]) and "tripdata" in str(table.trips(raw=True).inputFiles()[0])


def test_a_partition_missing_from_the_table_shows(spark, source):
    """The counts of files and table come from different data."""
    less = source.saved().where("NOT (anio = 2025 AND tipo_taxi = 'green')")
    rows = evolution.vigilancia_diferencias(source.record_counts(), less).where("diferencia <> 0").collect()
    assert [(r.tipo_taxi, str(r.fecha), r.diferencia) for r in rows] == [("green", "2025-01-01", 7)]


def test_columns_that_appear_and_disappear(source):
    rows = as_tuples(evolution.vigilancia_columnas(source.footers()))
    assert ("yellow", "2025-01", "cbd_congestion_fee", "aparece") in rows
    assert ("green", "2026-06", "vendorid", "desaparece") not in rows
