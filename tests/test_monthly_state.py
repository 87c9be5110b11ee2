"""Aggregates of file months, merged and replaced."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from milepost.operators import compare, indicators
from milepost.plans import monthly_state as state
from milepost.plans.monthly_state import MonthlyState
from milepost.streaming.arrival import ingest_arrivals, read_ingested
from tests.drift_files import write_month


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def year(trips):
    rows = []
    for i in range(400):
        day = dt.datetime(2026, 1 + i % 12, 1 + i % 7, 8)
        rows.append(
            {
                "mes": 1 + i % 12 if i % 50 else 3,  # some trips lie in another month's file
                "tipo_taxi": ("yellow", "green")[i % 3 == 0],
                "pickup_datetime": day if i % 41 else None,
                "payment_type": i % 4 or None,
                "trip_distance": i / 7 if i % 11 else None,
                "cbd_congestion_fee": 0.75 if i % 5 else 0.0,
                "total_amount": float("nan") if i == 77 else i * 1.01,
            }
        )
    return trips(*rows)


def test_equal_to_the_reports_over_trips(spark, tmp_path, year):
    kept = MonthlyState(spark, str(tmp_path / "state"))
    kept.update(year)
    merged = kept.read()
    wide = year.withColumnsRenamed({"origen_id": "o"})
    assert rows_of(state.demanda_mensual(merged)) == rows_of(indicators.demanda_mensual(year))
    assert rows_of(state.cargo_congestion(merged)) == rows_of(indicators.cargo_congestion(year))
    assert rows_of(state.distribucion_pago(merged, [2026], 2)) == rows_of(compare.distribucion_pago(wide, [2026], 2))
    assert [str(r) for r in rows_of(state.resumen_mensual(merged, None, 2))] == [
        str(r) for r in rows_of(compare.resumen_mensual(wide, None, 2))
    ]
    days = {(r.anio, r.tipo_taxi): r.dias for r in state.dias_activos(merged).collect()}
    plain = year.groupBy("anio", "tipo_taxi").agg(F.count_distinct(F.to_date("pickup_datetime")).alias("d")).collect()
    assert days == {(r.anio, r.tipo_taxi): r.d for r in plain}


def test_sketches_stay_within_their_rank_error(spark, tmp_path, trips):
    base = trips({}).drop("trip_distance", "total_amount", "mes")
    many = base.crossJoin(
        spark.range(60_000).select(
            (F.col("id") % 12 + 1).cast("int").alias("mes"),
            F.round(F.rand(3) * 40, 1).alias("trip_distance"),
            F.pow(F.rand(4), 3).alias("total_amount"),
        )
    )
    kept = MonthlyState(spark, str(tmp_path / "state"))
    kept.update(many)
    for r in state.percentiles(kept.read(), state.PROBS).where("medida <> 'duracion'").collect():
        ordered = sorted(x[0] for x in many.select({"distancia": "trip_distance", "monto": "total_amount"}[r.medida]).collect())
        assert r.n == 60_000
        for p, value in zip(state.PROBS, r.cuantiles):
            low = sum(x < value for x in ordered) / r.n
            high = sum(x <= value for x in ordered) / r.n
            assert low - state.RANK_ERROR <= p <= high + state.RANK_ERROR
    assert all(r.dentro for r in state.control_percentiles(kept.read(), many, state.PROBS).collect())
    wrong = many.withColumn("total_amount", F.col("total_amount") / 2)
    checked = state.control_percentiles(kept.read(), wrong, state.PROBS).where("medida = 'monto'").collect()
    assert not any(r.dentro for r in checked)


def test_only_the_month_that_came_again_is_read(spark, tmp_path):
    root, table, control = tmp_path / "raw", str(tmp_path / "table"), str(tmp_path / "control")
    for month in (1, 2, 3):
        write_month(root, "yellow", 2024, month, 3 + month)
    ingest_arrivals(spark, str(root), table, control)
    kept = MonthlyState(spark, str(tmp_path / "state"))
    kept.update(read_ingested(spark, table))
    untouched = [e for e in kept.table._entries(1) if "mes=2" not in e]
    write_month(root, "yellow", 2024, 2, 11)
    ingest_arrivals(spark, str(root), table, control)
    trips = read_ingested(spark, table)
    plan = trips.where("tipo_taxi = 'yellow' AND anio = 2024 AND mes = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tipo_taxi" in plan
    # The files of the other months may go: they are not read.
    for entry in trips.inputFiles():
        if "mes=2" not in entry:
            (tmp_path / entry.removeprefix("file://")).unlink()
    kept.update(trips, [("yellow", 2024, 2)])
    found = {r.fecha.month: r.viajes for r in state.demanda_mensual(kept.read()).collect()}
    assert found == {1: 4, 2: 11, 3: 6}
    assert [e for e in kept.table._entries(2) if "mes=2" not in e] == untouched


def test_empty(spark, tmp_path, year):
    kept = MonthlyState(spark, str(tmp_path / "state"))
    kept.update(year.limit(0))
    assert state.demanda_mensual(kept.read()).collect() == []
    assert state.percentiles(kept.read(), state.PROBS).collect() == []
