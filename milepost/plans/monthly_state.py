"""Aggregates of each file month, kept beside the trips and merged when a report asks.

Trips are only ever added or replaced by the month, so counts, sums, active days and quantile
sketches are kept by service, file month, pickup month and payment code. When a month arrives again
its part of the table is replaced, and no other month is read. Everything kept can be merged over
months: sums as exact totals, days as bitmaps, and values as sketches with a known rank error.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.functions.expressions import exact_total, in_year, month_start, percent, rounded, sum_of_totals
from milepost.plans.versions import VersionedTable

PARTITIONS = ("tipo_taxi", "anio", "mes")
#: Of the sketches: with 1024, a quantile's rank is off by less than 0.5 % of the values.
SKETCH_K, RANK_ERROR = 1024, 0.005
PROBS = (0.5, 0.9, 0.95, 0.99)
SUMMED = ("trip_distance", "total_amount", "fare_amount", "tip_amount", "cbd_congestion_fee")
SKETCHED = {"distancia": "trip_distance", "duracion": "duracion_min", "monto": "total_amount"}
COLUMNS = (*PARTITIONS, "pickup_datetime", "duracion_min", "payment_type", *SUMMED)

_DDL = ", ".join(
    [
        "mes_inicio date, payment_type bigint, viajes bigint, con_cargo bigint, dias binary",
        *[f"n_{c} bigint, suma_{c} struct<exacto:decimal(38,6),resto:double>" for c in SUMMED],
        *[f"boceto_{m} binary" for m in SKETCHED],
        "tipo_taxi string, anio int, mes int",
    ]
)


class MonthlyState:
    """The aggregates at ``path``, one partition per service and file month."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.table = VersionedTable(spark, path, _DDL, PARTITIONS)

    def update(self, trips: DataFrame, months: Iterable[Sequence[object]] | None = None) -> int:
        """Aggregate ``months`` (service, year, month) of ``trips`` again, or all; returns the new version."""
        if months is None:
            return self.table.replace(_aggregated(trips))
        months = list(months)
        wanted = F.lit(False)
        for values in months:
            same = F.lit(True)
            for column, value in zip(PARTITIONS, values):
                same = same & (F.col(column) == value)
            wanted = wanted | same
        return self.table.replace_partitions(_aggregated(trips.where(wanted)), months)

    def read(self) -> DataFrame:
        return self.table.read()


def _aggregated(trips: DataFrame) -> DataFrame:
    pickup = F.col("pickup_datetime")
    sums = [
        c
        for name in SUMMED
        for c in (
            F.count(name).alias(f"n_{name}"),
            exact_total(F.col(name)).cast("struct<exacto:decimal(38,6),resto:double>").alias(f"suma_{name}"),
        )
    ]
    # A day of the month is a bit; NaN has no rank.
    sketches = [
        F.kll_sketch_agg_double(F.when(~F.isnan(column), F.col(column)), SKETCH_K).alias(f"boceto_{name}")
        for name, column in SKETCHED.items()
    ]
    grouped = trips.groupBy(*PARTITIONS, F.trunc(pickup, "month").alias("mes_inicio"), "payment_type").agg(
        F.count(F.lit(1)).alias("viajes"),
        F.count_if(F.col("cbd_congestion_fee") > 0).alias("con_cargo"),
        F.bitmap_construct_agg(F.coalesce(F.dayofmonth(pickup), F.lit(0)).cast("long")).alias("dias"),
        *sums,
        *sketches,
    )
    return grouped.select("mes_inicio", "payment_type", "viajes", "con_cargo", "dias",
                          *[c for n in SUMMED for c in (f"n_{n}", f"suma_{n}")],
                          *[f"boceto_{m}" for m in SKETCHED], *PARTITIONS)


def _of_years(state: DataFrame, years: Sequence[int] | None) -> DataFrame:
    return state if years is None else state.where(F.col("anio").isin(*years))


def _shown(value: Column, digits: int | None) -> Column:
    return value if digits is None else rounded(value, digits)


def _mean(name: str) -> Column:
    return F.try_divide(sum_of_totals(f"suma_{name}"), F.sum(f"n_{name}"))


def resumen_mensual(state: DataFrame, years: Sequence[int] | None = None, digits: int | None = None) -> DataFrame:
    """Trips, mean distance and revenue per year, pickup month and service."""
    return (
        _of_years(state, years)
        .groupBy("anio", F.month("mes_inicio").alias("mes"), "tipo_taxi")
        .agg(
            F.sum("viajes").alias("viajes"),
            _shown(_mean("trip_distance"), digits).alias("distancia_media"),
            _shown(sum_of_totals("suma_total_amount"), digits).alias("monto_total"),
        )
        .orderBy("anio", "mes", "tipo_taxi")
    )


def distribucion_pago(state: DataFrame, years: Sequence[int] | None = None, digits: int | None = None) -> DataFrame:
    """Trips, mean fare and mean tip per year, service and payment code."""
    return (
        _of_years(state, years)
        .groupBy("anio", "tipo_taxi", "payment_type")
        .agg(
            F.sum("viajes").alias("viajes"),
            _shown(_mean("fare_amount"), digits).alias("tarifa_media"),
            _shown(_mean("tip_amount"), digits).alias("propina_media"),
        )
        .orderBy("anio", "tipo_taxi", F.desc("viajes"), "payment_type")
    )


def _monthly(state: DataFrame) -> DataFrame:
    """Trips dated in their file's year, per file month and service."""
    return state.where(in_year(F.col("mes_inicio"), F.col("anio"))).groupBy(
        month_start(F.col("anio"), F.col("mes")).alias("fecha"), "tipo_taxi"
    )


def demanda_mensual(state: DataFrame) -> DataFrame:
    """Trips per file month and per calendar day of that month."""
    per_day = rounded(F.col("viajes") / F.dayofmonth(F.last_day("fecha")), 1)
    return _monthly(state).agg(F.sum("viajes").alias("viajes")).withColumn("viajes_por_dia", per_day).orderBy("fecha", "tipo_taxi")


def cargo_congestion(state: DataFrame) -> DataFrame:
    """Share of trips with the congestion fee, and revenue from it, per file month and service."""
    return (
        _monthly(state)
        .agg(
            F.sum("viajes").alias("viajes"),
            rounded(percent(F.sum("con_cargo"), F.sum("viajes"))).alias("pct_viajes_con_cargo"),
            rounded(sum_of_totals("suma_cbd_congestion_fee")).alias("recaudacion_usd"),
        )
        .orderBy("fecha", "tipo_taxi")
    )


def dias_activos(state: DataFrame) -> DataFrame:
    """Trips, days with a trip, and trips per such day, per file year and service."""
    by_month = state.where("mes_inicio IS NOT NULL").groupBy("anio", "tipo_taxi", "mes_inicio").agg(
        F.sum("viajes").alias("viajes"), F.bitmap_or_agg("dias").alias("dias")
    )
    return (
        by_month.groupBy("anio", "tipo_taxi")
        .agg(F.sum("viajes").alias("viajes"), F.sum(F.bitmap_count("dias")).alias("dias"))
        .withColumn("viajes_por_dia", rounded(F.col("viajes") / F.col("dias"), 1))
        .orderBy("anio", "tipo_taxi")
    )


def percentiles(state: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``tipo_taxi, medida, n, cuantiles`` of all months together, from the merged sketches."""
    merged = state.groupBy("tipo_taxi").agg(
        *[F.kll_merge_agg_double(f"boceto_{m}", SKETCH_K).alias(m) for m in SKETCHED]
    )
    rows = F.array(*[F.struct(F.lit(m).alias("medida"), F.col(m).alias("boceto")) for m in SKETCHED])
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    return merged.select("tipo_taxi", F.inline(rows)).select(
        "tipo_taxi",
        "medida",
        F.kll_sketch_get_n_double("boceto").alias("n"),
        F.kll_sketch_get_quantile_double("boceto", ranks).alias("cuantiles"),
    )


def control_percentiles(state: DataFrame, trips: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Is the true rank of each sketched quantile within the error bound? ``tipo_taxi, medida, p, n, dentro``.

    The rank is counted over all trips: a quantile stands for the ranks of the values equal to it.
    """
    found = percentiles(state, probs).select(
        "tipo_taxi", "medida", "n", F.posexplode("cuantiles").alias("k", "valor")
    )
    wide = found.groupBy(F.col("tipo_taxi").alias("_tipo")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws(" ", "medida", "k"), "valor"))).alias("valores")
    )
    # One row per service: broadcast.
    checked = trips.join(F.broadcast(wide), F.col("tipo_taxi") == F.col("_tipo"))
    ranks = []
    for name, column in SKETCHED.items():
        for k in range(len(probs)):
            value = F.col("valores")[f"{name} {k}"]
            below, up_to = F.count_if(F.col(column) < value), F.count_if(F.col(column) <= value)
            ranks.append(F.struct(F.lit(name).alias("medida"), F.lit(k).alias("k"), below.alias("bajo"), up_to.alias("hasta")))
    counted = checked.groupBy("tipo_taxi").agg(F.array(*ranks).alias("r")).select("tipo_taxi", F.inline("r"))
    p = F.try_element_at(F.array(*[F.lit(float(x)) for x in probs]), F.col("k") + 1)
    inside = (F.col("bajo") / F.col("n") <= p + RANK_ERROR) & (F.col("hasta") / F.col("n") >= p - RANK_ERROR)
    return (
        counted.join(found.drop("valor"), ["tipo_taxi", "medida", "k"])
        .select("tipo_taxi", "medida", p.alias("p"), "n", inside.alias("dentro"))
        .orderBy("tipo_taxi", "medida", "p")
    )
