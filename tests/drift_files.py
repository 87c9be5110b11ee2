"""A small folder of monthly files whose schemas drift, in the plain layout."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

TIMES = {"yellow": "tpep", "green": "lpep"}


def write_month(root: Path, service: str, year: int, month: int, rows: int, **changes) -> Path:
    """``changes``: ``passengers`` (Arrow type), ``drop`` (columns), ``add`` (name -> array type and value)."""
    start = dt.datetime(year, month, 2, 8)
    columns = {
        "VendorID": pa.array([1] * rows, pa.int32()),
        f"{TIMES[service]}_pickup_datetime": pa.array(
            [start + dt.timedelta(hours=i) for i in range(rows)], pa.timestamp("us")
        ),
        f"{TIMES[service]}_dropoff_datetime": pa.array(
            [start + dt.timedelta(hours=i, minutes=12) for i in range(rows)], pa.timestamp("us")
        ),
        "passenger_count": pa.array([1 + i % 3 for i in range(rows)], changes.get("passengers", pa.int64())),
        "trip_distance": pa.array([2.5] * rows, pa.float64()),
        "RatecodeID": pa.array([1] * rows, pa.int64()),
        "payment_type": pa.array([1 + i % 2 for i in range(rows)], pa.int64()),
        "fare_amount": pa.array([10.0] * rows, pa.float64()),
        "tip_amount": pa.array([1.5] * rows, pa.float64()),
        "total_amount": pa.array([12.0] * rows, pa.float64()),
        "PULocationID": pa.array([1 + i % 2 for i in range(rows)], pa.int32()),
        "DOLocationID": pa.array([3] * rows, pa.int32()),
    }
    for name, (kind, value) in changes.get("add", {}).items():
        columns[name] = pa.array([value] * rows, kind)
    for name in changes.get("drop", ()):
        columns.pop(name)
    path = root / service / str(year) / f"{service}_tripdata_{year}-{month:02d}.parquet"
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)
    return path


FEE = {"cbd_congestion_fee": (pa.float64(), 0.75)}


def write_drift_set(root: Path) -> Path:
    airport = {"Airport_fee": (pa.float64(), 1.0)}
    write_month(root, "yellow", 2024, 1, 3, add=airport)
    write_month(root, "yellow", 2024, 2, 4, add=airport)
    write_month(
        root, "yellow", 2025, 1, 5, passengers=pa.float64(), add={"airport_fee": (pa.float64(), 1.0), **FEE}
    )
    write_month(
        root, "yellow", 2026, 6, 6, passengers=pa.float64(), add={**FEE, "request_source": (pa.string(), "HV0003")}
    )
    # Same folder as above, but the passenger count is an integer again.
    write_month(root, "yellow", 2026, 7, 2, add={**FEE, "request_source": (pa.string(), None)})
    write_month(root, "green", 2025, 1, 7, passengers=pa.int32(), add=FEE)
    # A column without any value is stored without a type.
    write_month(root, "green", 2026, 6, 1, drop=["RatecodeID"], add={**FEE, "RatecodeID": (pa.null(), None)})
    zones = root / "zones" / "lookup.csv"
    zones.parent.mkdir(parents=True, exist_ok=True)
    zones.write_text(
        "LocationID,Borough,Zone,service_zone\n1,Queens,A,x\n2,Bronx,B,\n3,Bronx,C,z\n4,Unknown,N/A,N/A\n"
    )
    return root
