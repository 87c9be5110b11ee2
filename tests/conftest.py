from __future__ import annotations

import datetime as dt

import pytest

from milepost.plans.model import VIAJES
from milepost.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "milepost-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
    )
    yield session
    session.stop()


DEFAULT_TRIP = {
    "anio": 2026,
    "mes": 1,
    "tipo_taxi": "yellow",
    "pickup_datetime": dt.datetime(2026, 1, 5, 10, 0),
    "dropoff_datetime": dt.datetime(2026, 1, 5, 10, 10),
    "duracion_min": 10.0,
    "passenger_count": 1,
    "trip_distance": 2.0,
    "ratecode_id": 1,
    "payment_type": 1,
    "fare_amount": 10.0,
    "tip_amount": 2.0,
    "total_amount": 13.0,
    "cbd_congestion_fee": 0.0,
    "request_source": None,
    "origen_id": 1,
    "destino_id": 2,
}


@pytest.fixture(scope="session")
def trips(spark):
    """Build ``viajes`` rows from the values that matter to a test."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in VIAJES.items())

    def build(*rows: dict):
        full = [tuple({**DEFAULT_TRIP, **row}[c] for c in VIAJES) for row in rows]
        return spark.createDataFrame(full, ddl)

    return build
