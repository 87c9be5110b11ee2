"""Every report by name, bound to a trip source.

``REPORTS[name](source)`` builds the DataFrame; ``REPORTS[name].title`` and the other
fields describe it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.functions.expressions import month_start
from milepost.functions.labels import SERVICIOS
from milepost.operators import compare, eda, evolution, explore, indicators, reshape, validate
from milepost.plans import monthly_state
from milepost.plans.model import VIAJES
from milepost.plans.trip_source import TripSource
from milepost.plans.workspace import new_folder
from milepost.sources.inventory import year_of
from milepost.streaming.arrival import ingest_arrivals, read_ingested
from milepost.streaming.watch import alerts_per_service, summarise, watch

Build = Callable[[TripSource], DataFrame]


@dataclass(frozen=True)
class Report:
    """A named report. ``display``, ``dimensions`` and ``metrics`` say how to chart it."""

    name: str
    title: str
    build: Build
    display: str = "table"
    dimensions: tuple[str, ...] = ()
    metrics: tuple[str, ...] = ()

    def __call__(self, source: TripSource) -> DataFrame:
        return self.build(source)


REPORTS: dict[str, Report] = {}


def report(name: str, title: str, display: str = "table", dimensions: str = "", metrics: str = ""):
    def register(build: Build) -> Build:
        REPORTS[name] = Report(
            name, title, build, display, tuple(dimensions.split()), tuple(metrics.split())
        )
        return build

    return register


def _year_trips(source: TripSource, *columns: str) -> DataFrame:
    """Trips from the files of the explored year."""
    year = source.settings.file_year
    if year is None:
        return source.trips(*columns)
    wanted = list(dict.fromkeys([*columns, "anio"]))
    return source.trips(*wanted).where(F.col("anio") == year).select(*columns)


def _year_files(source: TripSource) -> DataFrame:
    files, year = source.monthly_files(), source.settings.file_year
    return files if year is None else files.where(F.col("anio") == year)


def _year_counts(source: TripSource, counts: DataFrame) -> DataFrame:
    year = source.settings.file_year
    return counts if year is None else counts.where(year_of(F.col("relativa")) == year)


def _year_footers(source: TripSource) -> DataFrame:
    footers, year = source.files().footers(), source.settings.file_year
    return footers if year is None else footers.where(year_of(F.col("relativa")) == year)


# Exploration of the monthly files


@report("q01_cantidad_archivos", "Monthly files per service")
def _(s):
    return explore.cantidad_archivos(_year_files(s))


@report("q02_cantidad_registros", "Records per service and in total")
def _(s):
    return explore.cantidad_registros(_year_counts(s, s.record_counts()))


@report("q03_registros_por_archivo", "Records per monthly file")
def _(s):
    return explore.registros_por_archivo(_year_counts(s, s.files().record_counts()))


@report("q04_esquema_yellow", "Merged schema of the yellow files")
def _(s):
    return explore.esquema(_year_footers(s), "yellow")


@report("q05_esquema_green", "Merged schema of the green files")
def _(s):
    return explore.esquema(_year_footers(s), "green")


@report("q06_muestra_registros", "First records per service")
def _(s):
    return explore.muestra_registros(
        _year_trips(s, *explore.SAMPLE_COLUMNS), s.settings.period, s.settings.sample_rows
    )


QUALITY_COLUMNS = (
    "tipo_taxi",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
)


@report("q07_calidad_datos", "Quality rule counts per service")
def _(s):
    return explore.calidad_datos(_year_trips(s, *QUALITY_COLUMNS), s.settings.quality_period)


# Exploratory profile


@report("q08_evolucion_mensual", "Monthly demand and revenue")
def _(s):
    return eda.evolucion_mensual(
        _year_trips(s, "tipo_taxi", "pickup_datetime", "total_amount"), s.settings.period
    )


def _clock_period(s: TripSource):
    return s.pickups_period or s.settings.period


@report("q09_patron_horario", "Demand by hour and kind of day")
def _(s):
    return eda.patron_horario(s.pickups(), _clock_period(s))


PROFILE_COLUMNS = (
    "tipo_taxi",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "total_amount",
)


@report("q10_caracteristicas_por_tipo", "Typical trip per service")
def _(s):
    return eda.caracteristicas_por_tipo(_year_trips(s, *PROFILE_COLUMNS), s.settings.period, s.settings.exact)


@report("q11_formas_pago", "Payment methods per service")
def _(s):
    return eda.formas_pago(_year_trips(s, "tipo_taxi", "payment_type"))


@report("q12_propinas_tarjeta", "Tips on card payments")
def _(s):
    return eda.propinas_tarjeta(
        _year_trips(s, "tipo_taxi", "payment_type", "fare_amount", "tip_amount"), s.settings.exact
    )


@report("q13_distribucion", "Percentiles of distance, duration and amount")
def _(s):
    return eda.distribucion(_year_trips(s, *PROFILE_COLUMNS), s.settings.period, exact=s.settings.exact)


@report("q14_atipicos_inconsistencias", "Outliers and inconsistencies per service")
def _(s):
    return eda.atipicos_inconsistencias(
        _year_trips(s, *QUALITY_COLUMNS), s.settings.period, s.settings.umbrales
    )


@report("q15_rutas_frecuentes", "Most frequent routes per service")
def _(s):
    return eda.rutas_frecuentes(_year_trips(s, "tipo_taxi", "origen_id", "destino_id"), s.settings.top_routes)


# Validation of added years


@report("q16_archivos_por_anio_tipo", "File coverage of chosen years")
def _(s):
    return validate.archivos_por_anio_tipo(s.monthly_files(), s.settings.years)


@report("q17_registros_conjuntos", "Records of chosen years read together")
def _(s):
    return validate.registros_conjuntos(s.record_counts(), s.settings.years)


@report("q18_comparacion_anual", "Chosen years side by side")
def _(s):
    return validate.comparacion_anual(
        s.trips("anio", "tipo_taxi", "pickup_datetime", "trip_distance", "total_amount"), s.settings.years
    )


# Comparison of reading files and reading the saved table

MONTHLY_COLUMNS = ("anio", "tipo_taxi", "pickup_datetime", "trip_distance", "total_amount")
PAYMENT_COLUMNS = ("anio", "tipo_taxi", "payment_type", "fare_amount", "tip_amount")


def _routes(trips: DataFrame) -> DataFrame:
    return trips.select(
        "anio",
        "tipo_taxi",
        F.col("origen_id").alias("pickup_location_id"),
        F.col("destino_id").alias("dropoff_location_id"),
    )


@report("q19_resumen_mensual", "Monthly summary, from the source")
def _(s):
    return compare.resumen_mensual(s.trips(*MONTHLY_COLUMNS, raw=True), s.settings.years, s.settings.digits)


@report("q19_resumen_mensual_tabla", "Monthly summary, from the saved table")
def _(s):
    return compare.resumen_mensual(s.saved(), s.settings.years, s.settings.digits)


@report("q20_distribucion_pago", "Payment distribution, from the source")
def _(s):
    return compare.distribucion_pago(s.trips(*PAYMENT_COLUMNS, raw=True), s.settings.years, s.settings.digits)


@report("q20_distribucion_pago_tabla", "Payment distribution, from the saved table")
def _(s):
    return compare.distribucion_pago(s.saved(), s.settings.years, s.settings.digits)


@report("q21_rutas_principales", "Main routes, from the source")
def _(s):
    trips = s.trips("anio", "tipo_taxi", "origen_id", "destino_id", raw=True)
    return compare.rutas_principales(_routes(trips), s.settings.years, s.settings.top_pairs)


@report("q21_rutas_principales_tabla", "Main routes, from the saved table")
def _(s):
    return compare.rutas_principales(_routes(s.saved()), s.settings.years, s.settings.top_pairs)


# Trip model


@report("q22_tabla_viajes", "Normalised trips read from the monthly files")
def _(s):
    return s.files().trips(raw=True)


@report("q23_tabla_zonas", "Zone lookup")
def _(s):
    return s.zones()


@report("q24_vista_viajes_validos", "Plausible trips")
def _(s):
    return s.valid(*VIAJES)


# Indicators


@report("q25_pasajeros_duracion", "Duration by passengers", "bar", "pasajeros", "duracion_mediana_min min_por_milla")
def _(s):
    return indicators.pasajeros_duracion(
        s.valid("passenger_count", "duracion_min", "trip_distance"), s.settings.exact
    )


@report("q26_duracion_mensual", "Duration by month", "line", "fecha tipo_taxi", "duracion_mediana_min")
def _(s):
    return indicators.duracion_mensual(s.valid("anio", "mes", "tipo_taxi", "duracion_min"), s.settings.exact)


@report("q27_pago_tarifa", "Fare by payment method", "bar", "forma_pago anio", "tarifa_base_media")
def _(s):
    return indicators.pago_tarifa(
        s.valid("anio", "payment_type", "fare_amount", "trip_distance"), s.settings.exact
    )


@report(
    "q28_origen_solicitud", "Fare by request origin", "bar", "origen", "tarifa_base_mediana tarifa_por_milla_mediana"
)
def _(s):
    columns = ("anio", "mes", "tipo_taxi", "request_source", "fare_amount", "trip_distance", "duracion_min")
    return indicators.origen_solicitud(
        s.valid(*columns), s.trips("anio", "mes", "request_source"), s.settings.service, s.settings.exact
    )


TIP_COLUMNS = ("payment_type", "fare_amount", "tip_amount")


@report("q29_propina_distancia", "Tip by distance", "bar", "rango_distancia anio", "propina_pct_tarifa")
def _(s):
    return indicators.propina_distancia(s.valid("anio", "trip_distance", *TIP_COLUMNS))


@report("q30_tipo_tarifa", "Use and cost of each rate", "bar", "tipo_tarifa anio", "tarifa_base_media")
def _(s):
    return indicators.tipo_tarifa(s.valid("anio", "ratecode_id", "fare_amount", "trip_distance", "duracion_min"))


@report("q31_destino_propina", "Destinations by tip share", "row", "destino", "propina_pct_tarifa")
def _(s):
    return indicators.destino_propina(
        s.valid("destino_id", *TIP_COLUMNS), s.zones(), s.settings.min_trips, s.settings.ends
    )


@report("q32_demanda_mensual", "Demand by month", "line", "fecha tipo_taxi", "viajes_por_dia")
def _(s):
    return indicators.demanda_mensual(s.trips("anio", "mes", "tipo_taxi", "pickup_datetime"))


@report("q33_hora_dia_semana", "Demand by hour and weekday", "line", "hora dia_semana", "pct_del_dia")
def _(s):
    return indicators.hora_dia_semana(s.valid_pickups())


@report("q34_cargo_congestion", "Congestion fee by month", "line", "fecha tipo_taxi", "pct_viajes_con_cargo")
def _(s):
    return indicators.cargo_congestion(s.trips("anio", "mes", "tipo_taxi", "pickup_datetime", "cbd_congestion_fee"))


# Evolution over comparable months


@report("q35_cobertura", "File coverage of all years")
def _(s):
    return validate.cobertura(s.monthly_files())


@report("q36_parquet_vs_tabla", "Records in files and in the saved table")
def _(s):
    return validate.parquet_vs_tabla(s.record_counts(), s.saved())


@report("q37_cambios_esquema", "Columns missing from some months")
def _(s):
    return validate.cambios_esquema(s.files().footers())


PERIOD_COLUMNS = (
    "anio",
    "mes",
    "tipo_taxi",
    "pickup_datetime",
    "duracion_min",
    "trip_distance",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "cbd_congestion_fee",
)


@report("q38_comparacion_enero_agosto", "Years over comparable months")
def _(s):
    return evolution.comparacion_periodo(
        s.trips(*PERIOD_COLUMNS), s.max_minutes, s.settings.last_month, s.settings.exact
    )


@report("q39_control_composicion", "Price and speed net of record mix")
def _(s):
    columns = (
        "anio", "mes", "tipo_taxi", "payment_type", "ratecode_id", "fare_amount", "trip_distance", "duracion_min"
    )
    return evolution.control_composicion(
        s.valid(*columns), s.settings.service, s.settings.last_month, s.settings.exact
    )


@report("q40_demanda_por_tipo_registro", "Demand of metered and unmetered records")
def _(s):
    return evolution.demanda_por_tipo_registro(
        s.trips("anio", "mes", "tipo_taxi", "pickup_datetime", "payment_type"),
        s.settings.service,
        s.settings.last_month,
    )


# Summaries and reshaping

VALIDITY_COLUMNS = ("anio", "tipo_taxi", "pickup_datetime", "duracion_min", "trip_distance", "total_amount")


@report("a01_resumen_validez", "Plausible share of all groups")
def _(s):
    return validate.resumen_validez(s.trips(*VALIDITY_COLUMNS), s.max_minutes, "left")


@report("a02_resumen_validez_interno", "Plausible share of groups with plausible trips")
def _(s):
    return validate.resumen_validez(s.trips(*VALIDITY_COLUMNS), s.max_minutes, "inner")


@report("a03_volumen_por_anio", "Records per year")
def _(s):
    return compare.volumen_por(s.trips("anio"), "anio")


@report("a04_cobertura_archivos", "Files per year and service")
def _(s):
    return validate.cobertura(s.monthly_files())


@report("a05_fuente_normalizada", "The 12 columns of the comparison source")
def _(s):
    return compare.fuente_normalizada(s.trips(*compare.COMPARISON_COLUMNS.values()))


@report("a06_materializar", "Saved table of chosen years")
def _(s):
    path = new_folder(s.spark, "materializado")
    table = compare.materializar(s.trips(raw=True), s.settings.years, path)
    return table.groupBy("anio", "tipo_taxi").agg(
        F.count(F.lit(1)).alias("registros"), F.count_distinct("mes").alias("meses")
    )


@report("a07_volumen_por_escenario", "Records of each year and of all years")
def _(s):
    return compare.volumen_por_escenario(s.trips("anio"), s.settings.years)


@report("a08_mes_pico", "Busiest month per service")
def _(s):
    return reshape.fila_maxima(
        REPORTS["q08_evolucion_mensual"](s), ["tipo_taxi"], "viajes_por_dia", [F.asc("mes")]
    )


@report("a08_hora_pico", "Busiest working-day hour per service")
def _(s):
    working = REPORTS["q09_patron_horario"](s).where("tipo_dia = 'laboral'")
    return reshape.fila_maxima(working, ["tipo_taxi"], "viajes", [F.asc("hora")])


@report("a08_pago_principal", "Main payment method per service")
def _(s):
    return reshape.fila_maxima(REPORTS["q11_formas_pago"](s), ["tipo_taxi"], "viajes", [F.asc("forma_pago")])


@report("a09_hallazgos_calidad", "Quality counters over all services")
def _(s):
    quality = REPORTS["q07_calidad_datos"](s)
    outside = next(c for c in quality.columns if c.startswith("pickup_fuera"))
    return explore.sumar_contadores(
        quality, outside, "duracion_negativa", "pasajeros_nulos", "distancia_no_positiva", "total_negativo"
    )


@report("a09_hallazgos_atipicos", "Outlier counters over all services")
def _(s):
    return explore.sumar_contadores(
        REPORTS["q14_atipicos_inconsistencias"](s), "registros", "distancia_no_positiva", "total_negativo"
    )


@report("a10_pivote_demanda", "Daily demand with one column per service")
def _(s):
    return reshape.pivotar(
        REPORTS["q32_demanda_mensual"](s), "fecha", "tipo_taxi", "viajes_por_dia", SERVICIOS
    )


@report("a12_meses_completos", "Median duration with a row for every month")
def _(s):
    known = s.valid("anio", "mes", "tipo_taxi").select(month_start(F.col("anio"), F.col("mes")).alias("fecha"), "tipo_taxi")
    return reshape.completar_meses(REPORTS["q26_duracion_mensual"](s), "fecha", ["tipo_taxi"], known)


@report("a13_indice_base", "Daily demand as an index of the first year")
def _(s):
    columns = ("anio", "mes", "tipo_taxi", "pickup_datetime", "duracion_min", "trip_distance", "total_amount")
    yearly = evolution.viajes_por_dia(s.trips(*columns), s.max_minutes, s.settings.last_month)
    return evolution.indice_base(yearly, ["tipo_taxi"], "anio", "viajes_por_dia", "indice_viajes")


@report("a14_matriz_dia_hora", "Weekday by hour matrix")
def _(s):
    return reshape.matriz_dia_hora(REPORTS["q33_hora_dia_semana"](s))


@report("a15_primeras_filas", "First 40 rows of the monthly demand")
def _(s):
    return reshape.primeras_filas(
        REPORTS["q32_demanda_mensual"](s), [F.asc("fecha"), F.asc("tipo_taxi")], 40
    )


# Ingest


@report("r01_firmas_parquet", "Files with a complete Parquet signature")
def _(s):
    return validate.firmas_por_tipo(s.signatures())


@report("r03_meses_esperados", "Every expected month with its state")
def _(s):
    return validate.meses_esperados(s.file_status(), s.settings.expected_years)


@report("r03_resumen_esperados", "Expected months by state")
def _(s):
    months = validate.meses_esperados(s.file_status(), s.settings.expected_years)
    return validate.resumen_esperados(months)


@report("r05_ingesta_incremental", "Records ingested from arriving files, after two runs")
def _(s):
    files = s.files()
    table, checkpoint = new_folder(s.spark, "ingesta"), new_folder(s.spark, "ingesta-control")
    for _run in range(2):
        ingest_arrivals(s.spark, files.root, table, checkpoint)
    return compare.volumen_por_servicio(read_ingested(s.spark, table))


@report("r06_vigilancia_registros", "Monthly share of incomplete records and its change")
def _(s):
    return evolution.vigilancia_registros(s.trips("anio", "mes", "tipo_taxi", "payment_type", "ratecode_id"))


@report("r06_vigilancia_diferencias", "Monthly records in files against the saved table")
def _(s):
    return evolution.vigilancia_diferencias(s.record_counts(), s.saved())


@report("r06_vigilancia_columnas", "Columns that appear or disappear between months")
def _(s):
    return evolution.vigilancia_columnas(s.files().footers())


@report("r06_alertas", "Alerts on monthly shares per service, watched in two runs")
def _(s):
    months = summarise(REPORTS["r06_vigilancia_registros"](s))
    summaries, found, checkpoint = (new_folder(s.spark, n) for n in ("resumenes", "alertas", "alertas-control"))
    half = s.settings.expected_years[len(s.settings.expected_years) // 2]
    for earlier in (True, False):
        of_run = months.where((F.year("fecha") < half) == earlier)
        of_run.coalesce(1).write.mode("append").parquet(summaries)
        alerts = watch(s.spark, summaries, found, checkpoint, s.settings.alert_change)
    return alerts_per_service(alerts, months)


# Reports from the aggregates that are kept for each file month


@report("s01_resumen_mensual", "Monthly summary, from the monthly state")
def _(s):
    return monthly_state.resumen_mensual(s.monthly_state.read(), s.settings.years, s.settings.digits)


@report("s02_distribucion_pago", "Payment distribution, from the monthly state")
def _(s):
    return monthly_state.distribucion_pago(s.monthly_state.read(), s.settings.years, s.settings.digits)


@report("s03_demanda_mensual", "Demand by month, from the monthly state")
def _(s):
    return monthly_state.demanda_mensual(s.monthly_state.read())


@report("s04_cargo_congestion", "Congestion fee by month, from the monthly state")
def _(s):
    return monthly_state.cargo_congestion(s.monthly_state.read())


@report("s05_dias_activos", "Trips per active day, from day bitmaps")
def _(s):
    return monthly_state.dias_activos(s.monthly_state.read())


@report("s06_percentiles_por_boceto", "Sketched percentiles against their true ranks")
def _(s):
    trips = s.trips("tipo_taxi", *monthly_state.SKETCHED.values())
    return monthly_state.control_percentiles(s.monthly_state.read(), trips, monthly_state.PROBS)
