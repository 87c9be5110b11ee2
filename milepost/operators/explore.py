"""First look at the monthly files: counts, schemas, a sample, quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.expressions import Period, in_period, top_per_group
from milepost.sources.inventory import monthly_file_of, service_of

UNKNOWN_SERVICE = "desconocido"


def cantidad_archivos(files: DataFrame) -> DataFrame:
    """Monthly files per service with first and last month, plus a ``total`` row."""
    per_service = files.groupBy(
        F.coalesce("tipo_taxi", F.lit(UNKNOWN_SERVICE)).alias("tipo_taxi")
    ).agg(
        F.count(F.lit(1)).alias("archivos"),
        F.min("mes").alias("primero"),
        F.max("mes").alias("ultimo"),
    )
    return _with_total(
        per_service,
        F.sum("archivos").alias("cantidad_archivos"),
        F.lpad(F.min("primero").cast("string"), 2, "0").alias("primer_mes"),
        F.lpad(F.max("ultimo").cast("string"), 2, "0").alias("ultimo_mes"),
    ).orderBy("tipo_taxi")


def _with_total(per_service: DataFrame, *aggs: Column) -> DataFrame:
    """Grand total next to the groups, over the small aggregate instead of the records."""
    rolled = per_service.rollup("tipo_taxi").agg(F.grouping("tipo_taxi").alias("_todos"), *aggs)
    label = F.when(F.col("_todos") == 1, "total").otherwise(F.col("tipo_taxi"))
    return rolled.withColumn("tipo_taxi", label).drop("_todos")


def cantidad_registros(counts: DataFrame) -> DataFrame:
    """Records per service and in total."""
    service = service_of(F.col("relativa"), UNKNOWN_SERVICE)
    per_service = counts.groupBy(service.alias("tipo_taxi")).agg(F.sum("registros").alias("n"))
    return _with_total(per_service, F.sum("n").alias("cantidad_registros"))


def registros_por_archivo(counts: DataFrame) -> DataFrame:
    """Records per monthly file."""
    path = F.col("relativa")
    return (
        counts.groupBy(
            service_of(path, UNKNOWN_SERVICE).alias("tipo_taxi"), monthly_file_of(path).alias("archivo")
        )
        .agg(F.sum("registros").alias("cantidad_registros"))
        .orderBy("tipo_taxi", "archivo")
    )


# Report names of the stored types, numeric ones from narrow to wide.
TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}
NUMERIC_WIDENING = ("int", "bigint", "float", "double")


def esquema(footers: DataFrame, service: str) -> DataFrame:
    """Merged schema of one service: every column once, with the widest type stored."""
    width = F.array_position(F.array(*[F.lit(t) for t in NUMERIC_WIDENING]), F.col("tipo"))
    merged = (
        footers.where(F.col("relativa").contains(service) & (F.col("tipo") != "void"))
        .groupBy(F.lower("columna").alias("clave"))
        .agg(
            F.min(F.struct("relativa", "posicion", "columna")).alias("primera"),
            F.count_distinct("tipo").alias("tipos"),
            F.min("tipo").alias("unico"),
            F.min(width).alias("angosto"),
            F.max(width).alias("ancho"),
        )
    )
    resolved = (
        F.when(F.col("tipos") == 1, F.col("unico"))
        .when(F.col("angosto") > 0, F.element_at(F.array(*[F.lit(t) for t in NUMERIC_WIDENING]), F.col("ancho").cast("int")))
        .otherwise("string")
    )
    names = F.create_map(*[F.lit(x) for item in TYPE_NAMES.items() for x in item])
    nothing = F.lit(None).cast("string")
    # Column order of the first file, then of the files that add columns.
    return (
        merged.withColumn("tipo", resolved)
        .orderBy("primera.relativa", "primera.posicion")
        .select(
            F.col("primera.columna").alias("column_name"),
            F.coalesce(F.try_element_at(names, F.col("tipo")), F.upper("tipo")).alias("column_type"),
            F.lit("YES").alias("null"),
            nothing.alias("key"),
            nothing.alias("default"),
            nothing.alias("extra"),
        )
    )


SAMPLE_COLUMNS = (
    "tipo_taxi",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "payment_type",
)


def muestra_registros(trips: DataFrame, period: Period, n: int = 5) -> DataFrame:
    """First ``n`` records per service in ``period``. Every column breaks ties, so it is repeatable."""
    order = [F.col(c).asc_nulls_last() for c in SAMPLE_COLUMNS[1:]]
    inside = trips.where(in_period(F.col("pickup_datetime"), period)).select(*SAMPLE_COLUMNS)
    return top_per_group(inside, ["tipo_taxi"], order, n).orderBy("tipo_taxi", "pickup_datetime")


def _outside_name(period: Period) -> str:
    """``pickup_fuera_2026`` for a whole calendar year, a general name otherwise."""
    (start, _, _), (end, _, _) = (edge.split("-") for edge in period)
    whole_year = period == (f"{start}-01-01", f"{int(start) + 1:04d}-01-01") and int(end) == int(start) + 1
    return f"pickup_fuera_{start}" if whole_year else "pickup_fuera_periodo"


def calidad_datos(trips: DataFrame, period: Period) -> DataFrame:
    """Ten rule counts per service over all records, none filtered."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    rules = {
        "pickup_nulo": pickup.isNull(),
        "dropoff_nulo": dropoff.isNull(),
        _outside_name(period): ~in_period(pickup, period),
        "duracion_negativa": dropoff < pickup,
        "pasajeros_nulos": F.col("passenger_count").isNull(),
        "pasajeros_no_positivos": F.col("passenger_count") <= 0,
        "distancia_nula": F.col("trip_distance").isNull(),
        "distancia_no_positiva": F.col("trip_distance") <= 0,
        "tarifa_negativa": F.col("fare_amount") < 0,
        "total_negativo": F.col("total_amount") < 0,
    }
    return rule_counts(trips, rules)


def rule_counts(trips: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Records and records breaking each rule, per service, in one pass."""
    return (
        trips.groupBy("tipo_taxi")
        .agg(F.count(F.lit(1)).alias("registros"), *[F.count_if(rule).alias(name) for name, rule in rules.items()])
        .orderBy("tipo_taxi")
    )


def sumar_contadores(per_service: DataFrame, *counters: str) -> DataFrame:
    """Counters added up over the services."""
    return per_service.agg(*[F.sum(c).alias(c) for c in counters])
