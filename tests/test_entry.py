"""The driver contract."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from milepost.oracle import ORACLE
from milepost.registry import REPORTS


def test_every_report_has_a_twin():
    assert set(REPORTS) == set(ORACLE)
    assert set(REPORTS) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(contract.SMOKE_DIR), reason="driver tables not available")
def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r.grupo for r in rows} == {"mas alta", "mas baja"}


@pytest.mark.skipif(not os.path.isdir(contract.SMOKE_DIR), reason="driver tables not available")
@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_runs_on_driver_tables(spark, name):
    """Rows and columns; their values are compared with the twins by the driver."""
    df = contract.queries()[name](spark, contract.SMOKE_DIR)
    assert df.columns and df.count() >= 0
