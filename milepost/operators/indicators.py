"""Ten indicators over plausible trips (two of them over all trips of the year)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions import labels
from milepost.functions.expressions import (
    exact_avg,
    exact_sum,
    exact_total,
    in_year,
    iso_weekday,
    labelled,
    month_start,
    percent,
    percent_of_rows,
    percent_within,
    rounded,
    sum_of_totals,
)
from milepost.functions.quantiles import grouped_medians

def _trips_count() -> Column:
    return F.count(F.lit(1)).alias("viajes")


def _rounded_columns(*names: str) -> list[Column]:
    return [rounded(F.col(name)).alias(name) for name in names]


def pasajeros_duracion(valid: DataFrame, exact: bool = True) -> DataFrame:
    """Duration by number of passengers, 1 to 6."""
    table = grouped_medians(
        valid.where(F.col("passenger_count").between(1, 6)).withColumnRenamed("passenger_count", "pasajeros"),
        ["pasajeros"],
        {"duracion_mediana_min": F.col("duracion_min")},
        aggs=[
            _trips_count(),
            F.avg("duracion_min").alias("duracion_media_min"),
            exact_avg(F.col("trip_distance")).alias("distancia_media"),
            F.try_divide(F.sum("duracion_min"), exact_sum(F.col("trip_distance"))).alias("min_por_milla"),
        ],
        exact=exact,
    )
    shown = _rounded_columns("duracion_media_min", "duracion_mediana_min", "distancia_media", "min_por_milla")
    return table.select("pasajeros", "viajes", *shown).orderBy("pasajeros")


def duracion_mensual(valid: DataFrame, exact: bool = True) -> DataFrame:
    """Mean and median duration per file month and service."""
    table = grouped_medians(
        valid.withColumn("fecha", month_start(F.col("anio"), F.col("mes"))),
        ["fecha", "tipo_taxi"],
        {"duracion_mediana_min": F.col("duracion_min")},
        aggs=[_trips_count(), F.avg("duracion_min").alias("duracion_media_min")],
        exact=exact,
    )
    shown = _rounded_columns("duracion_media_min", "duracion_mediana_min")
    return table.select("fecha", "tipo_taxi", "viajes", *shown).orderBy("fecha", "tipo_taxi")


def _year_text() -> Column:
    return F.col("anio").cast("string")


def pago_tarifa(valid: DataFrame, exact: bool = True) -> DataFrame:
    """Base fare by payment method and year."""
    method = labelled(F.col("payment_type"), labels.FORMA_PAGO_TARIFA, labels.FORMA_PAGO_TARIFA_RESTO)
    table = grouped_medians(
        valid.where(F.col("fare_amount") > 0).withColumns({"anio": _year_text(), "forma_pago": method}),
        ["anio", "forma_pago"],
        {"tarifa_base_mediana": F.col("fare_amount")},
        aggs=[
            _trips_count(),
            exact_avg(F.col("fare_amount")).alias("tarifa_base_media"),
            exact_avg(F.col("trip_distance")).alias("distancia_media"),
        ],
        exact=exact,
    )
    shown = _rounded_columns("tarifa_base_media", "tarifa_base_mediana", "distancia_media")
    return table.select("anio", "forma_pago", "viajes", *shown).orderBy("anio", F.desc("viajes"), "forma_pago")


def origen_solicitud(
    valid: DataFrame, trips: DataFrame, service: str = "yellow", exact: bool = True
) -> DataFrame:
    """Fares by origin of the request, from the first month any trip names one."""
    month = month_start(F.col("anio"), F.col("mes"))
    first = trips.where(F.col("request_source").isNotNull()).select(F.min(month)).scalar()
    origin = F.when(F.col("request_source").isNull(), labels.SIN_PLATAFORMA).otherwise(
        labelled(F.col("request_source"), labels.PLATAFORMA, labels.PLATAFORMA_RESTO)
    )
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    table = grouped_medians(
        valid.where((F.col("tipo_taxi") == service) & (fare > 0) & (month >= first)).withColumn("origen", origin),
        ["origen"],
        {
            "tarifa_base_mediana": fare,
            "distancia_mediana": distance,
            "duracion_mediana_min": F.col("duracion_min"),
            "tarifa_por_milla_mediana": F.try_divide(fare, distance),
        },
        aggs=[_trips_count(), exact_avg(distance).alias("distancia_media")],
        exact=exact,
    )
    shown = _rounded_columns(
        "tarifa_base_mediana",
        "distancia_mediana",
        "duracion_mediana_min",
        "tarifa_por_milla_mediana",
        "distancia_media",
    )
    # At most one row per origin label.
    shares = percent_within(table, "viajes", [], "pct_viajes")
    return shares.select("origen", "viajes", "pct_viajes", *shown).orderBy(F.desc("viajes"), "origen")


def _tipped_card(valid: DataFrame) -> DataFrame:
    return valid.where(
        (F.col("payment_type") == 1) & (F.col("fare_amount") > 0) & (F.col("tip_amount") >= 0)
    )


def propina_distancia(valid: DataFrame) -> DataFrame:
    """Card tips by distance band and year."""
    distance = F.col("trip_distance")
    (limit, name), *others = labels.RANGO_DISTANCIA
    band = F.when(distance < limit, name)
    for limit, name in others:
        band = band.when(distance < limit, name)
    return (
        _tipped_card(valid)
        .groupBy(_year_text().alias("anio"), band.otherwise(labels.RANGO_DISTANCIA_RESTO).alias("rango_distancia"))
        .agg(
            _trips_count(),
            rounded(exact_avg(F.col("tip_amount"))).alias("propina_media"),
            rounded(percent(exact_sum(F.col("tip_amount")), exact_sum(F.col("fare_amount")))).alias("propina_pct_tarifa"),
            rounded(percent_of_rows(F.col("tip_amount") > 0)).alias("pct_con_propina"),
        )
        .orderBy("anio", "rango_distancia")
    )


def tipo_tarifa(valid: DataFrame) -> DataFrame:
    """Use and cost of each rate per year."""
    rate = labelled(F.col("ratecode_id"), labels.TIPO_TARIFA, labels.TIPO_TARIFA_RESTO)
    table = (
        valid.where(F.col("ratecode_id").isNotNull() & (F.col("fare_amount") > 0))
        .groupBy(_year_text().alias("anio"), rate.alias("tipo_tarifa"))
        .agg(
            _trips_count(),
            rounded(exact_avg(F.col("fare_amount"))).alias("tarifa_base_media"),
            rounded(exact_avg(F.col("trip_distance"))).alias("distancia_media"),
            rounded(F.avg("duracion_min")).alias("duracion_media_min"),
        )
    )
    shares = percent_within(table, "viajes", ["anio"], "pct_viajes")
    return shares.select(
        "anio", "tipo_tarifa", "viajes", "pct_viajes", "tarifa_base_media", "distancia_media", "duracion_media_min"
    ).orderBy("anio", "tipo_tarifa")


def destino_propina(valid: DataFrame, zones: DataFrame, min_trips: int = 10_000, n: int = 10) -> DataFrame:
    """Destinations with the highest and the lowest tip share.

    Trips are counted per zone id before the lookup, so the join sees one row per zone, and
    the two ends come from distributed top-``n`` sorts. A destination in both ends is listed
    once, as high.
    """
    per_zone = (
        _tipped_card(valid)
        .groupBy(F.col("destino_id").alias("zona_id"))
        .agg(
            _trips_count(),
            exact_total(F.col("tip_amount")).alias("propina"),
            exact_total(F.col("fare_amount")).alias("tarifa"),
        )
    )
    label = F.concat("zona", F.lit(" ("), "barrio", F.lit(")"))
    known = zones.where(~F.col("zona").isin(*labels.ZONAS_EXCLUIDAS)).select("zona_id", label.alias("destino"))
    per_label = (
        per_zone.join(known, "zona_id")
        .groupBy("destino")
        .agg(
            F.sum("viajes").alias("viajes"),
            sum_of_totals("propina").alias("propina"),
            sum_of_totals("tarifa").alias("tarifa"),
        )
        .where(F.col("viajes") >= min_trips)
        .select(
            "destino",
            "viajes",
            rounded(F.col("propina") / F.col("viajes")).alias("propina_media"),
            rounded(percent(F.col("propina"), F.col("tarifa"))).alias("propina_pct_tarifa"),
        )
    )
    share = F.col("propina_pct_tarifa")
    name = F.col("destino").asc_nulls_last()
    high = per_label.orderBy(share.desc_nulls_last(), name).limit(n)
    low = per_label.orderBy(share.asc_nulls_last(), name).limit(n)
    in_high = high.select(F.col("destino").alias("alto"))
    low = low.join(in_high, F.col("destino").eqNullSafe(F.col("alto")), "left_anti")
    columns = ("destino", "viajes", "propina_media", "propina_pct_tarifa")
    return (
        high.select(F.lit("mas alta").alias("grupo"), *columns)
        .unionByName(low.select(F.lit("mas baja").alias("grupo"), *columns))
        .orderBy(F.desc("propina_pct_tarifa"), name)
    )


def _monthly(trips: DataFrame, *aggs: Column) -> DataFrame:
    return (
        trips.where(in_year(F.col("pickup_datetime"), F.col("anio")))
        .groupBy(month_start(F.col("anio"), F.col("mes")).alias("fecha"), "tipo_taxi")
        .agg(_trips_count(), *aggs)
    )


def demanda_mensual(trips: DataFrame) -> DataFrame:
    """Trips per file month and per calendar day of that month."""
    per_day = rounded(F.col("viajes") / F.dayofmonth(F.last_day("fecha")), 1)
    return _monthly(trips).withColumn("viajes_por_dia", per_day).orderBy("fecha", "tipo_taxi")


def hora_dia_semana(pickups: DataFrame, names: Sequence[str] = labels.DIAS) -> DataFrame:
    """Trips by weekday and hour, and each hour's share of its weekday."""
    counts = pickups.groupBy(
        iso_weekday(F.col("pickup_datetime")).alias("dow"), F.hour("pickup_datetime").alias("hora")
    ).agg(_trips_count())
    shares = percent_within(counts, "viajes", ["dow"], "pct_del_dia")
    day = F.try_element_at(F.array(*[F.lit(name) for name in names]), F.col("dow"))
    return shares.select("hora", day.alias("dia_semana"), "viajes", "pct_del_dia").orderBy("dia_semana", "hora")


def cargo_congestion(trips: DataFrame) -> DataFrame:
    """Share of trips with the congestion fee, and revenue from it, per file month and service."""
    fee = F.col("cbd_congestion_fee")
    return _monthly(
        trips,
        rounded(percent_of_rows(fee > 0)).alias("pct_viajes_con_cargo"),
        rounded(exact_sum(fee)).alias("recaudacion_usd"),
    ).orderBy("fecha", "tipo_taxi")
