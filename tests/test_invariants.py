"""Totals equal the sum of their groups, and shares add up to 100."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from milepost.plans.trip_source import StarTrips
from milepost.registry import REPORTS

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not available")


@pytest.fixture(scope="module")
def source(spark):
    return StarTrips(spark, SF_DIR)


@pytest.mark.parametrize(
    "name, keys, share",
    [
        ("q09_patron_horario", ["tipo_taxi", "tipo_dia"], "porcentaje"),
        ("q11_formas_pago", ["tipo_taxi"], "porcentaje"),
        ("q28_origen_solicitud", [], "pct_viajes"),
        ("q30_tipo_tarifa", ["anio"], "pct_viajes"),
        ("q33_hora_dia_semana", ["dia_semana"], "pct_del_dia"),
        ("q40_demanda_por_tipo_registro", ["anio"], "pct_del_anio"),
    ],
)
def test_shares_add_up(source, name, keys, share):
    sums = REPORTS[name](source).groupBy(*keys).agg(F.sum(share).alias("s"), F.count(F.lit(1)).alias("n"))
    for row in sums.collect():
        assert abs(row.s - 100.0) <= 0.005 * row.n + 1e-9


def test_totals(source):
    counts = {r.tipo_taxi: r.cantidad_registros for r in REPORTS["q02_cantidad_registros"](source).collect()}
    total = counts.pop("total")
    assert total == sum(counts.values()) == source.table("lineitem").count()
    per_year = REPORTS["q17_registros_conjuntos"](source).collect()
    for year in {r.anio for r in per_year}:
        parts = {r.tipo_taxi: r.registros for r in per_year if r.anio == year}
        assert parts.pop("total") == sum(parts.values())
    per_file = REPORTS["q03_registros_por_archivo"](source).agg(F.sum("cantidad_registros")).first()[0]
    assert per_file == total


def test_joins_follow_the_wanted_columns(source):
    """A table no wanted column comes from is not read."""
    plan = source.trips("anio", "total_amount")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FileScan") == 1 and "l_orderkey" not in plan
    plan = source.trips("origen_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "o_orderkey" not in plan


def test_filters_and_columns_reach_the_scan(source):
    df = REPORTS["q29_propina_distancia"](source)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan
    assert "l_partkey" not in plan and "o_totalprice" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_reports_answer_from_a_saved_table_only_if_it_is_given(spark, tmp_path):
    """What ran before in the session changes neither plans nor rows."""
    folder = str(tmp_path / "in")
    for name in ("orders", "customer", "supplier", "lineitem"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    first = StarTrips(spark, folder)
    n = REPORTS["q19_resumen_mensual_tabla"](first).agg(F.sum("viajes")).first()[0]
    assert "l_shipdate" in REPORTS["q07_calidad_datos"](first)._jdf.queryExecution().optimizedPlan().toString()
    on_table = StarTrips(spark, folder, table=first.saved_path)
    plan = REPORTS["q07_calidad_datos"](on_table)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_shipdate" not in plan and "pickup_datetime" in plan
    assert REPORTS["q19_resumen_mensual"](on_table).agg(F.sum("viajes")).first()[0] == n
    # The tables change under the same path.
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    lineitem.unionByName(lineitem).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    second = StarTrips(spark, folder)
    assert REPORTS["q19_resumen_mensual_tabla"](second).agg(F.sum("viajes")).first()[0] == 2 * n
    assert REPORTS["q19_resumen_mensual"](second).agg(F.sum("viajes")).first()[0] == 2 * n
