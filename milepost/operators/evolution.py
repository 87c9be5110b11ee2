"""Year-over-year views on comparable months, and what mix of records explains them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from milepost.functions import labels
from milepost.functions.expressions import (
    in_year,
    month_start,
    percent,
    percent_of_rows,
    percent_within,
    rounded,
)
from milepost.functions.quantiles import grouped_medians
from milepost.plans.model import plausible
from milepost.sources.inventory import month_of, period_of, service_of, year_of

LAST_MONTH = 8


def comparacion_periodo(
    trips: DataFrame, max_minutes: float, last_month: int = LAST_MONTH, exact: bool = True
) -> DataFrame:
    """Demand and fee share on all trips of the year next to medians and card shares on plausible ones.

    Plausible trips are a subset of the trips of the year, so one pass serves both, and only
    groups with a plausible trip are shown.
    """
    valid = F.coalesce(plausible(max_minutes), F.lit(False))
    card = F.col("payment_type") == 1

    def on_valid(column: str) -> Column:
        return F.when(valid, F.col(column))

    # A trip of the year falls on one of 366 days at most.
    days = F.size(F.collect_set(F.dayofyear("pickup_datetime")))
    table = grouped_medians(
        trips.where((F.col("mes") <= last_month) & in_year(F.col("pickup_datetime"), F.col("anio"))),
        ["anio", "tipo_taxi"],
        {
            "duracion_mediana_min": on_valid("duracion_min"),
            "distancia_mediana": on_valid("trip_distance"),
            "tarifa_base_mediana": on_valid("fare_amount"),
        },
        aggs=[
            (F.count(F.lit(1)) / days).alias("viajes_por_dia"),
            percent_of_rows(F.col("cbd_congestion_fee") > 0).alias("pct_con_peaje"),
            F.count_if(valid).alias("validos"),
            percent_of_rows(card, among=valid).alias("pct_tarjeta"),
            percent_of_rows(F.col("tip_amount") > 0, among=valid & card).alias("pct_tarjeta_con_propina"),
        ],
        exact=exact,
    )
    shown = (
        "duracion_mediana_min",
        "distancia_mediana",
        "tarifa_base_mediana",
        "pct_tarjeta",
        "pct_tarjeta_con_propina",
        "pct_con_peaje",
    )
    return (
        table.where("validos > 0")
        .select(
            "anio",
            "tipo_taxi",
            rounded(F.col("viajes_por_dia"), 0).alias("viajes_por_dia"),
            *[rounded(F.col(c)).alias(c) for c in shown],
        )
        .orderBy(F.desc("tipo_taxi"), "anio")
    )


def control_composicion(
    valid: DataFrame, service: str = "yellow", last_month: int = LAST_MONTH, exact: bool = True
) -> DataFrame:
    """Share of unmetered records, and price and speed on standard-rate trips only, in one pass."""
    payment, fare, distance = F.col("payment_type"), F.col("fare_amount"), F.col("trip_distance")
    minutes = F.col("duracion_min")
    standard = F.coalesce((F.col("ratecode_id") == 1) & (fare > 0), F.lit(False))
    medians = {
        "distancia_mediana_sin_taximetro": F.when(payment == 0, distance),
        "tarifa_mediana_estandar": F.when(standard, fare),
        "usd_por_milla_estandar": F.when(standard, F.try_divide(fare, distance)),
        "distancia_mediana_estandar": F.when(standard, distance),
        "duracion_mediana_estandar": F.when(standard, minutes),
        "mph_mediana_estandar": F.when(standard, F.try_divide(distance, minutes / F.lit(60.0))),
    }
    table = grouped_medians(
        valid.where((F.col("tipo_taxi") == service) & (F.col("mes") <= last_month)),
        ["anio"],
        medians,
        aggs=[
            percent_of_rows(payment == 0).alias("pct_sin_taximetro"),
            percent(F.count_if(payment == 1), F.count_if(payment.isin(1, 2))).alias("pct_tarjeta_vs_efectivo"),
            F.count_if(standard).alias("estandar"),
        ],
        exact=exact,
    )
    first, *rest = medians
    shown = ("pct_sin_taximetro", first, "pct_tarjeta_vs_efectivo", *rest)
    return (
        table.where("estandar > 0").select("anio", *[rounded(F.col(c)).alias(c) for c in shown]).orderBy("anio")
    )


def demanda_por_tipo_registro(trips: DataFrame, service: str = "yellow", last_month: int = LAST_MONTH) -> DataFrame:
    """Trips per active day and share of the year, metered against unmetered records."""
    kind = F.when(F.col("payment_type") == 0, labels.SIN_TAXIMETRO).otherwise(labels.CON_TAXIMETRO)
    daily = (
        trips.where(
            (F.col("tipo_taxi") == service)
            & (F.col("mes") <= last_month)
            & in_year(F.col("pickup_datetime"), F.col("anio"))
        )
        .groupBy("anio", kind.alias("tipo_registro"), F.to_date("pickup_datetime").alias("dia"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    yearly = daily.groupBy("anio", "tipo_registro").agg(
        F.sum("n").alias("viajes"), F.count(F.lit(1)).alias("dias")
    )
    shares = percent_within(yearly, "viajes", ["anio"], "pct_del_anio")
    return shares.select(
        "anio",
        "tipo_registro",
        rounded(F.col("viajes") / F.col("dias"), 0).alias("viajes_por_dia"),
        "pct_del_anio",
    ).orderBy("tipo_registro", "anio")


def indice_base(
    table: DataFrame, keys: list[str], order: str, measure: str, name: str = "indice"
) -> DataFrame:
    """Add ``measure`` as an index: 100 in the first year of each group."""
    base = F.first_value(measure).over(
        Window.partitionBy(*keys)
        .orderBy(F.col(order).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return table.withColumn(name, rounded(percent(F.col(measure), base), 1))


def viajes_por_dia(trips: DataFrame, max_minutes: float, last_month: int = LAST_MONTH) -> DataFrame:
    """Trips of the year per active day, of groups with a plausible trip: counts only."""
    daily = (
        trips.where((F.col("mes") <= last_month) & in_year(F.col("pickup_datetime"), F.col("anio")))
        .groupBy("anio", "tipo_taxi", F.to_date("pickup_datetime").alias("dia"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(plausible(max_minutes)).alias("validos"))
    )
    return (
        daily.groupBy("anio", "tipo_taxi")
        .agg(F.sum("n").alias("viajes"), F.count(F.lit(1)).alias("dias"), F.sum("validos").alias("validos"))
        .where("validos > 0")
        .select("anio", "tipo_taxi", rounded(F.col("viajes") / F.col("dias"), 0).alias("viajes_por_dia"))
    )


def vigilancia_registros(trips: DataFrame) -> DataFrame:
    """Monthly shares of unmetered and unknown-rate records, and their change on the calendar month before.

    The change is NULL where that month has no records.
    """
    unknown = F.col("ratecode_id").isNull() | (F.col("ratecode_id") == 99)
    monthly = trips.groupBy(
        "tipo_taxi", month_start(F.col("anio"), F.col("mes")).alias("fecha")
    ).agg(
        F.count(F.lit(1)).alias("registros"),
        rounded(percent_of_rows(F.col("payment_type") == 0)).alias("pct_sin_taximetro"),
        rounded(percent_of_rows(unknown)).alias("pct_tarifa_desconocida"),
    )
    window = Window.partitionBy("tipo_taxi").orderBy("fecha")
    follows = F.lag("fecha").over(window) == F.add_months("fecha", -1)
    changes = {
        f"cambio_{c}": rounded(F.when(follows, F.col(c) - F.lag(c).over(window)))
        for c in ("pct_sin_taximetro", "pct_tarifa_desconocida")
    }
    return monthly.withColumns(changes).orderBy("tipo_taxi", "fecha")


def vigilancia_diferencias(counts: DataFrame, table: DataFrame) -> DataFrame:
    """Records per service and month in the files and in the saved table; a missing side counts as 0."""
    path = F.col("relativa")
    files = counts.groupBy(
        service_of(path, "").alias("tipo_taxi"), month_start(year_of(path), month_of(path)).alias("fecha")
    ).agg(F.sum("registros").alias("registros_archivos"))
    saved = table.groupBy("tipo_taxi", month_start(F.col("anio"), F.col("mes")).alias("fecha")).agg(
        F.count(F.lit(1)).alias("registros_tabla")
    )
    both = files.join(saved, ["tipo_taxi", "fecha"], "full").fillna(0, ["registros_archivos", "registros_tabla"])
    difference = F.col("registros_archivos") - F.col("registros_tabla")
    return both.withColumn("diferencia", difference).orderBy("tipo_taxi", "fecha")


# What can happen to a column.
APARECE, DESAPARECE = "aparece", "desaparece"


def vigilancia_columnas(footers: DataFrame) -> DataFrame:
    """Columns that a service's month has and the month before (of those present) has not, or the reverse."""
    path = F.col("relativa")
    seen = footers.select(
        service_of(path, "").alias("tipo_taxi"), period_of(path).alias("periodo"), F.lower("columna").alias("columna")
    ).distinct()
    by_month = Window.partitionBy("tipo_taxi").orderBy("periodo")
    months = seen.groupBy("tipo_taxi", "periodo").agg(F.collect_set("columna").alias("hay"))
    months = months.withColumn("habia", F.lag("hay").over(by_month)).where("habia IS NOT NULL")

    def changed(here: str, there: str, event: str) -> Column:
        return F.transform(F.array_except(here, there), lambda c: F.struct(c.alias("columna"), F.lit(event).alias("cambio")))

    changes = changed("hay", "habia", APARECE), changed("habia", "hay", DESAPARECE)
    return (
        months.select("tipo_taxi", "periodo", F.explode(F.concat(*changes)).alias("x"))
        .select("tipo_taxi", "periodo", "x.columna", "x.cambio")
        .orderBy("tipo_taxi", "periodo", "columna")
    )
