"""Coverage of the monthly files and agreement between files and saved table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions.expressions import exact_avg, in_year, percent, rounded
from milepost.functions.labels import SERVICIOS
from milepost.plans.model import plausible
from milepost.sources.inventory import period_of, service_of, year_of


def archivos_por_anio_tipo(files: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Monthly files per year and service: count, first, last and distinct months."""
    if years is not None:
        files = files.where(F.col("anio").isin(*years))
    return (
        files.groupBy("anio", F.coalesce("tipo_taxi", F.lit("")).alias("tipo_taxi"))
        .agg(
            F.count(F.lit(1)).alias("archivos"),
            F.min("mes").alias("primer_mes"),
            F.max("mes").alias("ultimo_mes"),
            F.count_distinct("mes").alias("meses_distintos"),
        )
        .orderBy("anio", "tipo_taxi")
    )


def cobertura(files: DataFrame) -> DataFrame:
    """Coverage of every year found."""
    return archivos_por_anio_tipo(files).drop("meses_distintos").orderBy("anio", "tipo_taxi")


def _records_per_year(counts: DataFrame, name: str) -> DataFrame:
    """Records per file year and service; a path naming no known service counts as green."""
    path = F.col("relativa")
    return counts.groupBy(
        year_of(path).alias("anio"), service_of(path, "green").alias("tipo_taxi")
    ).agg(F.sum("registros").alias(name))


def registros_conjuntos(counts: DataFrame, years: Sequence[int]) -> DataFrame:
    """Records per year and service with a ``total`` row per year, from one pass."""
    yearly = _records_per_year(counts, "n").where(F.col("anio").isin(*years))
    rolled = yearly.rollup("anio", "tipo_taxi").agg(
        F.grouping("anio").alias("_sin_anio"),
        F.grouping("tipo_taxi").alias("_sin_tipo"),
        F.sum("n").alias("registros"),
    )
    label = F.when(F.col("_sin_tipo") == 1, "total").otherwise(F.col("tipo_taxi"))
    return (
        rolled.where(F.col("_sin_anio") == 0)
        .select("anio", label.alias("tipo_taxi"), "registros")
        .orderBy("anio", "tipo_taxi")
    )


def comparacion_anual(trips: DataFrame, years: Sequence[int]) -> DataFrame:
    """Trips dated in their file's year, with means over positive distances and amounts not negative."""
    distance, total = F.col("trip_distance"), F.col("total_amount")
    return (
        trips.where(F.col("anio").isin(*years) & in_year(F.col("pickup_datetime"), F.col("anio")))
        .groupBy("anio", "tipo_taxi")
        .agg(
            F.count(F.lit(1)).alias("viajes"),
            rounded(exact_avg(F.when(distance > 0, distance))).alias("distancia_media"),
            rounded(exact_avg(F.when(total >= 0, total))).alias("monto_medio"),
        )
        .orderBy("anio", "tipo_taxi")
    )


def parquet_vs_tabla(counts: DataFrame, table: DataFrame, missing_as_zero: bool = False) -> DataFrame:
    """Records in files against records in the saved table.

    The difference is NULL where one side has no such year and service, or a number with
    ``missing_as_zero``.
    """
    raw = _records_per_year(counts, "registros_parquet")
    saved = table.groupBy("anio", "tipo_taxi").agg(F.count(F.lit(1)).alias("registros_tabla"))
    both = raw.join(saved, ["anio", "tipo_taxi"], "full")
    if missing_as_zero:
        both = both.fillna(0, ["registros_parquet", "registros_tabla"])
    return both.select(
        "anio",
        "tipo_taxi",
        "registros_parquet",
        "registros_tabla",
        (F.col("registros_parquet") - F.col("registros_tabla")).alias("diferencia"),
    ).orderBy("anio", "tipo_taxi")


def cambios_esquema(footers: DataFrame) -> DataFrame:
    """Columns that only some months of a service carry, with first and last month."""
    path = F.col("relativa")
    seen = footers.select(
        service_of(path, "").alias("tipo_taxi"), period_of(path).alias("periodo"), "columna"
    ).distinct()
    months = seen.select("tipo_taxi", "periodo").distinct().groupBy("tipo_taxi").agg(
        F.count("periodo").alias("archivos_tipo")
    )
    per_column = seen.groupBy("tipo_taxi", "columna").agg(
        F.count("periodo").alias("archivos_con_columna"),
        F.min("periodo").alias("desde"),
        F.max("periodo").alias("hasta"),
    )
    return (
        per_column.join(months, "tipo_taxi")
        .where(F.col("archivos_con_columna") < F.col("archivos_tipo"))
        .select("tipo_taxi", "columna", "archivos_con_columna", "archivos_tipo", "desde", "hasta")
        .orderBy("tipo_taxi", "desde", "columna")
    )


def resumen_validez(trips: DataFrame, max_minutes: float, how: str = "left") -> DataFrame:
    """Records, plausible records and their share per year and service, in one pass.

    ``how='inner'`` leaves out groups without any plausible record, as an inner join would.
    """
    table = trips.groupBy("anio", "tipo_taxi").agg(
        F.count(F.lit(1)).alias("registros"), F.count_if(plausible(max_minutes)).alias("validos")
    )
    if how == "inner":
        table = table.where("validos > 0")
    return table.withColumn(
        "pct_validos", rounded(percent(F.col("validos"), F.col("registros")))
    ).orderBy("anio", "tipo_taxi")


def firmas_por_tipo(status: DataFrame) -> DataFrame:
    """Valid and invalid monthly files per service."""
    return (
        status.groupBy(F.coalesce("tipo_taxi", F.lit("desconocido")).alias("tipo_taxi"))
        .agg(F.count_if("valido").alias("validos"), F.count_if(~F.col("valido")).alias("invalidos"))
        .orderBy("tipo_taxi")
    )


# States of an expected month.
EXISTENTE, INVALIDO, FALTANTE = "existente", "invalido", "faltante"


def meses_esperados(status: DataFrame, years: Sequence[int]) -> DataFrame:
    """Every month of ``years`` for every service with its state."""
    spark = status.sparkSession
    calendar = (
        spark.range(1)
        .select(F.explode(F.array(*[F.lit(y) for y in years])).alias("anio"))
        .select("anio", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes"))
        .select(F.explode(F.array(*[F.lit(s) for s in SERVICIOS])).alias("tipo_taxi"), "anio", "mes")
    )
    known = status.groupBy("tipo_taxi", "anio", "mes").agg(F.bool_or("valido").alias("valido"))
    state = F.when(F.col("valido"), EXISTENTE).when(~F.col("valido"), INVALIDO).otherwise(FALTANTE)
    return (
        calendar.join(known, ["tipo_taxi", "anio", "mes"], "left")
        .select("tipo_taxi", "anio", "mes", state.alias("estado"))
        .orderBy("tipo_taxi", "anio", "mes")
    )


def resumen_esperados(months: DataFrame) -> DataFrame:
    """Months per service and state."""
    return months.groupBy("tipo_taxi", "estado").agg(F.count(F.lit(1)).alias("meses")).orderBy("tipo_taxi", "estado")
