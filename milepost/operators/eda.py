"""Exploratory profile of the trips of a period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions import labels
from milepost.functions.expressions import (
    Period,
    exact_avg,
    exact_sum,
    exact_total,
    hours_crossed,
    in_period,
    is_weekend,
    labelled,
    minutes_between,
    percent,
    percent_of_rows,
    percent_within,
    rounded,
    sum_of_totals,
    top_per_group,
)
from milepost.functions.quantiles import grouped_medians, grouped_quantiles
from milepost.operators.explore import rule_counts
from milepost.plans.settings import Umbrales

PICKUP, DROPOFF = "pickup_datetime", "dropoff_datetime"


def evolucion_mensual(trips: DataFrame, period: Period) -> DataFrame:
    """Trips, trips per active day and non-negative revenue, per month and service.

    Counting days first gives the distinct days without a distinct aggregate.
    """
    revenue = F.when(F.col("total_amount") >= 0, F.col("total_amount")).otherwise(0.0)
    daily = (
        trips.where(in_period(F.col(PICKUP), period))
        .groupBy("tipo_taxi", F.to_date(F.col(PICKUP)).alias("dia"))
        .agg(F.count(F.lit(1)).alias("n"), exact_total(revenue).alias("monto"))
    )
    return (
        daily.groupBy("tipo_taxi", F.month("dia").alias("mes"))
        .agg(F.sum("n").alias("viajes"), F.count(F.lit(1)).alias("dias"), sum_of_totals("monto").alias("monto"))
        .select(
            "tipo_taxi",
            "mes",
            "viajes",
            rounded(F.col("viajes") / F.col("dias"), 1).alias("viajes_por_dia"),
            rounded(F.col("monto")).alias("monto_total"),
        )
        .orderBy("mes", "tipo_taxi")
    )


def patron_horario(pickups: DataFrame, period: Period) -> DataFrame:
    """Trips by hour and kind of day, and each hour's share within service and kind of day."""
    kind = F.when(is_weekend(F.col(PICKUP)), "fin_semana").otherwise("laboral")
    counts = (
        pickups.where(in_period(F.col(PICKUP), period))
        .groupBy("tipo_taxi", kind.alias("tipo_dia"), F.hour(F.col(PICKUP)).alias("hora"))
        .agg(F.count(F.lit(1)).alias("viajes"))
    )
    shares = percent_within(counts, "viajes", ["tipo_taxi", "tipo_dia"], "porcentaje")
    return shares.orderBy("tipo_taxi", "tipo_dia", "hora")


def _measurable(trips: DataFrame, period: Period) -> DataFrame:
    return trips.where(
        in_period(F.col(PICKUP), period)
        & (F.col(DROPOFF) >= F.col(PICKUP))
        & (F.col("trip_distance") > 0)
        & (F.col("total_amount") >= 0)
    ).withColumn("minutos", minutes_between(F.col(PICKUP), F.col(DROPOFF)))


def caracteristicas_por_tipo(trips: DataFrame, period: Period, exact: bool = True) -> DataFrame:
    """Mean and median distance, duration and amount, and mean passengers, per service."""
    medians = {
        "distancia_mediana": "trip_distance",
        "duracion_mediana_min": "minutos",
        "monto_mediano": "total_amount",
    }
    table = grouped_medians(
        _measurable(trips, period),
        ["tipo_taxi"],
        {name: F.col(c) for name, c in medians.items()},
        aggs=[
            F.count(F.lit(1)).alias("viajes_validos"),
            exact_avg(F.col("trip_distance")).alias("distancia_media"),
            F.avg("minutos").alias("duracion_media_min"),
            F.avg("passenger_count").alias("pasajeros_promedio"),
            exact_avg(F.col("total_amount")).alias("monto_promedio"),
        ],
        exact=exact,
    )
    order = (
        "distancia_media",
        "distancia_mediana",
        "duracion_media_min",
        "duracion_mediana_min",
        "pasajeros_promedio",
        "monto_promedio",
        "monto_mediano",
    )
    return table.select(
        "tipo_taxi", "viajes_validos", *[rounded(F.col(c)).alias(c) for c in order]
    ).orderBy("tipo_taxi")


def formas_pago(trips: DataFrame) -> DataFrame:
    """Payment methods per service with their share."""
    method = labelled(F.col("payment_type"), labels.FORMA_PAGO, labels.FORMA_PAGO_RESTO)
    counts = trips.groupBy("tipo_taxi", method.alias("forma_pago")).agg(F.count(F.lit(1)).alias("viajes"))
    shares = percent_within(counts, "viajes", ["tipo_taxi"], "porcentaje")
    return shares.orderBy("tipo_taxi", F.desc("viajes"), "forma_pago")


def propinas_tarjeta(trips: DataFrame, exact: bool = True) -> DataFrame:
    """Tips on card payments with a positive fare."""
    tip = F.col("tip_amount")
    paid = trips.where((F.col("payment_type") == 1) & (F.col("fare_amount") > 0) & (tip >= 0))
    table = grouped_medians(
        paid,
        ["tipo_taxi"],
        {"propina_mediana": tip},
        aggs=[
            F.count(F.lit(1)).alias("pagos_tarjeta"),
            exact_avg(tip).alias("propina_promedio"),
            percent_of_rows(tip > 0).alias("pct_con_propina"),
            percent(exact_sum(tip), exact_sum(F.col("fare_amount"))).alias("propina_sobre_tarifa_pct"),
        ],
        exact=exact,
    )
    order = ("propina_promedio", "propina_mediana", "pct_con_propina", "propina_sobre_tarifa_pct")
    return table.select("tipo_taxi", "pagos_tarjeta", *[rounded(F.col(c)).alias(c) for c in order]).orderBy("tipo_taxi")


def distribucion(
    trips: DataFrame, period: Period, probs: Sequence[float] = (0.5, 0.9, 0.95, 0.99), exact: bool = True
) -> DataFrame:
    """Percentiles and maximum of distance, duration and amount per service, one row per variable."""
    variables = {"distancia_millas": "trip_distance", "duracion_min": "minutos", "monto_usd": "total_amount"}
    table = grouped_quantiles(
        _measurable(trips, period),
        ["tipo_taxi"],
        {f"q_{name}": F.col(c) for name, c in variables.items()},
        probs=probs,
        aggs=[F.max(c).alias(f"max_{name}") for name, c in variables.items()],
        exact=exact,
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("variable"),
                *[rounded(F.col(f"q_{name}")[i]).alias(f"p{p * 100:g}") for i, p in enumerate(probs)],
                rounded(F.col(f"max_{name}")).alias("maximo"),
            )
            for name in variables
        ]
    )
    return table.select("tipo_taxi", F.inline(rows)).orderBy("tipo_taxi", "variable")


def atipicos_inconsistencias(trips: DataFrame, period: Period, umbrales: Umbrales = Umbrales()) -> DataFrame:
    """Nine outlier and inconsistency counts per service."""
    rules = {
        "duracion_negativa": F.col(DROPOFF) < F.col(PICKUP),
        f"duracion_mayor_{umbrales.horas}h": hours_crossed(F.col(PICKUP), F.col(DROPOFF)) > umbrales.horas,
        "distancia_no_positiva": F.col("trip_distance") <= 0,
        f"distancia_mayor_{umbrales.millas}mi": F.col("trip_distance") > umbrales.millas,
        "pasajeros_no_positivos": F.col("passenger_count") <= 0,
        f"pasajeros_mayor_{umbrales.pasajeros}": F.col("passenger_count") > umbrales.pasajeros,
        "tarifa_negativa": F.col("fare_amount") < 0,
        "total_negativo": F.col("total_amount") < 0,
        f"total_mayor_{umbrales.monto}": F.col("total_amount") > umbrales.monto,
    }
    return rule_counts(trips.where(in_period(F.col(PICKUP), period)), rules)


def rutas_frecuentes(trips: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent origin-destination pairs per service; pairs with a missing end are left out."""
    pairs = (
        trips.where(F.col("origen_id").isNotNull() & F.col("destino_id").isNotNull())
        .groupBy("tipo_taxi", F.col("origen_id").alias("origen"), F.col("destino_id").alias("destino"))
        .agg(F.count(F.lit(1)).alias("viajes"))
    )
    order = [F.desc("viajes"), F.asc("origen"), F.asc("destino")]
    return top_per_group(pairs, ["tipo_taxi"], order, n).orderBy("tipo_taxi", *order)
