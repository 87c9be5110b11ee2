"""The three reports used to compare reading files with reading the saved table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.expressions import exact_avg, exact_sum, rounded, top_per_group
from milepost.plans.tables import write_trips

# Columns of the comparison source and the trip columns they come from.
COMPARISON_COLUMNS = {
    "anio": "anio",
    "tipo_taxi": "tipo_taxi",
    "pickup_datetime": "pickup_datetime",
    "dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "payment_type": "payment_type",
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "total_amount": "total_amount",
    "pickup_location_id": "origen_id",
    "dropoff_location_id": "destino_id",
}


def fuente_normalizada(trips: DataFrame) -> DataFrame:
    """The 12 columns both sides of the comparison share."""
    return trips.select(*[F.col(c).alias(name) for name, c in COMPARISON_COLUMNS.items()])


def _of_years(source: DataFrame, years: Sequence[int] | None) -> DataFrame:
    return source if years is None else source.where(F.col("anio").isin(*years))


def _shown(value: Column, digits: int | None) -> Column:
    return value if digits is None else rounded(value, digits)


def resumen_mensual(source: DataFrame, years: Sequence[int] | None = None, digits: int | None = None) -> DataFrame:
    """Trips, mean distance and revenue per year, pickup month and service."""
    return (
        _of_years(source, years)
        .groupBy("anio", F.month("pickup_datetime").alias("mes"), "tipo_taxi")
        .agg(
            F.count(F.lit(1)).alias("viajes"),
            _shown(exact_avg(F.col("trip_distance")), digits).alias("distancia_media"),
            _shown(exact_sum(F.col("total_amount")), digits).alias("monto_total"),
        )
        .orderBy("anio", "mes", "tipo_taxi")
    )


def distribucion_pago(source: DataFrame, years: Sequence[int] | None = None, digits: int | None = None) -> DataFrame:
    """Trips, mean fare and mean tip per year, service and payment code."""
    return (
        _of_years(source, years)
        .groupBy("anio", "tipo_taxi", "payment_type")
        .agg(
            F.count(F.lit(1)).alias("viajes"),
            _shown(exact_avg(F.col("fare_amount")), digits).alias("tarifa_media"),
            _shown(exact_avg(F.col("tip_amount")), digits).alias("propina_media"),
        )
        .orderBy("anio", "tipo_taxi", F.desc("viajes"), "payment_type")
    )


def rutas_principales(source: DataFrame, years: Sequence[int] | None = None, n: int = 20) -> DataFrame:
    """Most frequent origin-destination pairs per year and service."""
    pairs = (
        _of_years(source, years)
        .groupBy("anio", "tipo_taxi", "pickup_location_id", "dropoff_location_id")
        .agg(F.count(F.lit(1)).alias("viajes"))
    )
    order = [
        F.desc("viajes"),
        F.col("pickup_location_id").asc_nulls_last(),
        F.col("dropoff_location_id").asc_nulls_last(),
    ]
    return top_per_group(pairs, ["anio", "tipo_taxi"], order, n).orderBy("anio", "tipo_taxi", *order)


def volumen_por(trips: DataFrame, key: str = "anio") -> DataFrame:
    """Records per value of ``key``."""
    return trips.groupBy(key).agg(F.count(F.lit(1)).alias("registros")).orderBy(key)


def volumen_por_servicio(trips: DataFrame) -> DataFrame:
    """Records per year and service."""
    return trips.groupBy("anio", "tipo_taxi").agg(F.count(F.lit(1)).alias("registros")).orderBy("anio", "tipo_taxi")


def volumen_por_escenario(trips: DataFrame, years: Sequence[int]) -> DataFrame:
    """Records of each year and of all years together, from one scan."""
    everything = "+".join(str(y) for y in years)
    rolled = (
        _of_years(trips, years)
        .groupBy("anio")
        .agg(F.count(F.lit(1)).alias("n"))
        .rollup("anio")
        .agg(F.grouping("anio").alias("_todos"), F.sum("n").alias("registros"))
    )
    label = F.when(F.col("_todos") == 1, everything).otherwise(F.col("anio").cast("string"))
    table = rolled.select(label.alias("escenario"), "registros", "_todos")
    if len(years) == 1:
        table = table.where(F.col("_todos") == 0)
    return table.drop("_todos").orderBy("escenario")


def materializar(trips: DataFrame, years: Sequence[int], path: str) -> DataFrame:
    """Save the trips of ``years`` to a new folder and return the saved table."""
    write_trips(trips, path, years)
    return trips.sparkSession.read.parquet(path)
