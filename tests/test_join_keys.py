"""Trips are joined by order alone: a comparison of years is no key that both sides are sorted by."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from milepost.functions.expressions import in_year
from milepost.plans.model import plausible
from milepost.registry import REPORTS
from tests.test_scale import settings, write_star


@pytest.mark.parametrize(
    "name", ["q25_pasajeros_duracion", "q26_duracion_mensual", "q27_pago_tarifa", "q32_demanda_mensual", "a12_meses_completos"]
)
def test_order_is_the_only_key(spark, tmp_path, name):
    source = write_star(spark, tmp_path, 3_000)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        plan = REPORTS[name](source)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"SortMergeJoin \[(l_orderkey.*?|year.*?)\], \[(.*?)\], ", plan)
    assert keys and all(re.fullmatch(r"l_orderkey#\d+L?", a) and re.fullmatch(r"o_orderkey#\d+L?", b) for a, b in keys)
    assert "Sort [year(" not in plan


def test_years_and_nulls(trips):
    df = trips(
        {"pickup_datetime": dt.datetime(2026, 12, 31, 23, 59)},
        {"pickup_datetime": dt.datetime(2027, 1, 1)},
        {"pickup_datetime": dt.datetime(2025, 12, 31, 23, 59)},
        {"pickup_datetime": None},
        {"anio": None},
    )
    assert [r[0] for r in df.select(in_year(F.col("pickup_datetime"), F.col("anio"))).collect()] == [True, False, False, None, None]
    assert df.where(plausible()).count() == 1
