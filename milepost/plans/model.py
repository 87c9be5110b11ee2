"""The normalised trip model.

``viajes`` has 17 columns. ``anio`` and ``mes`` say which monthly file a row came
from, not when the trip took place; reports compare both where it matters.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.expressions import minutes_between
from milepost.functions.labels import SERVICIOS
from milepost.sources.drift import FILE_PATH
from milepost.sources.inventory import month_of_record, year_of_record

# Columns and types of the raw files that the model uses.
RAW_COMMON = {
    "passenger_count": "bigint",
    "trip_distance": "double",
    "RatecodeID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "cbd_congestion_fee": "double",
    "request_source": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
}
PICKUP_DROPOFF = {
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    "green": ("lpep_pickup_datetime", "lpep_dropoff_datetime"),
}

# Columns and types of the normalised table.
VIAJES = {
    "anio": "int",
    "mes": "int",
    "tipo_taxi": "string",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "duracion_min": "double",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "ratecode_id": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "cbd_congestion_fee": "double",
    "request_source": "string",
    "origen_id": "int",
    "destino_id": "int",
}
# Columns the plausibility rule reads.
PLAUSIBLE_COLUMNS = ("anio", "pickup_datetime", "duracion_min", "trip_distance", "total_amount")
MAX_MINUTES = 360


def raw_contract(service: str) -> dict[str, str]:
    pickup, dropoff = PICKUP_DROPOFF[service]
    return {pickup: "timestamp_ntz", dropoff: "timestamp_ntz", **RAW_COMMON}


def raw_contracts() -> dict[str, dict[str, str]]:
    return {service: raw_contract(service) for service in SERVICIOS}


def normalise_all(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Both services, read with :func:`raw_contracts`, as one ``viajes`` relation."""
    parts = [normalise(raw[service], service) for service in SERVICIOS if service in raw]
    return reduce(DataFrame.unionByName, parts)


def normalise(raw: DataFrame, service: str) -> DataFrame:
    """Rows of one service, read with :func:`raw_contract`, as ``viajes`` rows."""
    pickup, dropoff = (F.col(c) for c in PICKUP_DROPOFF[service])
    # Partition columns where the layout has them, else the file name. A filter on either lets
    # Spark skip files without opening them.
    year = F.col("anio").cast("int") if "anio" in raw.columns else year_of_record(F.col(FILE_PATH))
    month = F.col("mes").cast("int") if "mes" in raw.columns else month_of_record(F.col(FILE_PATH))
    return raw.select(
        year.alias("anio"),
        month.alias("mes"),
        F.lit(service).alias("tipo_taxi"),
        pickup.alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        minutes_between(pickup, dropoff).alias("duracion_min"),
        "passenger_count",
        "trip_distance",
        F.col("RatecodeID").alias("ratecode_id"),
        "payment_type",
        "fare_amount",
        "tip_amount",
        "total_amount",
        F.coalesce("cbd_congestion_fee", F.lit(0.0)).alias("cbd_congestion_fee"),
        "request_source",
        F.col("PULocationID").alias("origen_id"),
        F.col("DOLocationID").alias("destino_id"),
    )


def plausible_sql(max_minutes: float = MAX_MINUTES) -> str:
    """The plausibility rule as SQL text, for columns and for catalog views.

    Years are compared by their difference. Where pickup and year come from two tables, an equality would become
    the first key of their join, and every comparison of its sorts would work out two years again.
    """
    return (
        f"year(pickup_datetime) - anio = 0 AND duracion_min > 0 AND duracion_min <= {float(max_minutes)}D "
        "AND trip_distance > 0 AND total_amount >= 0"
    )


def plausible(max_minutes: float = MAX_MINUTES) -> Column:
    """A trip inside its file's year, of positive length, with a duration up to the cap."""
    return F.expr(plausible_sql(max_minutes))
