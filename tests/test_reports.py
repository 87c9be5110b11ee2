"""NULLs, ties, boundaries and empty groups that the driver tables do not hold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from milepost.operators import compare, eda, evolution, explore, indicators, reshape, validate
from milepost.plans.model import plausible
from milepost.plans.settings import Umbrales

YEAR = ("2026-01-01", "2027-01-01")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_plausible_boundaries(trips):
    df = trips(
        {"duracion_min": 360.0},
        {"duracion_min": 360.001},
        {"duracion_min": 0.0},
        {"trip_distance": 0.0},
        {"total_amount": -0.01},
        {"total_amount": 0.0},
        {"pickup_datetime": dt.datetime(2025, 12, 31, 23, 59)},
        {"pickup_datetime": None},
        {"trip_distance": None},
    )
    assert df.where(plausible()).count() == 2


def test_quality_counts(trips):
    df = trips(
        {"pickup_datetime": None, "duracion_min": None},
        {"dropoff_datetime": None, "passenger_count": None},
        {"pickup_datetime": dt.datetime(2027, 1, 1)},
        {"passenger_count": 0, "trip_distance": -1.0, "fare_amount": -3.0, "total_amount": -3.0},
        {"trip_distance": None, "tipo_taxi": "green"},
    )
    table = explore.calidad_datos(df, YEAR)
    assert "pickup_fuera_2026" in table.columns
    green, yellow = table.collect()
    assert yellow.asDict() == {
        "tipo_taxi": "yellow",
        "registros": 4,
        "pickup_nulo": 1,
        "dropoff_nulo": 1,
        "pickup_fuera_2026": 1,
        "duracion_negativa": 1,
        "pasajeros_nulos": 1,
        "pasajeros_no_positivos": 1,
        "distancia_nula": 0,
        "distancia_no_positiva": 1,
        "tarifa_negativa": 1,
        "total_negativo": 1,
    }
    assert green.distancia_nula == 1 and green.registros == 1
    totals = explore.sumar_contadores(table, "registros", "distancia_nula").first()
    assert tuple(totals) == (5, 1)


def test_outlier_counts_use_hour_boundaries(trips):
    df = trips(
        {"pickup_datetime": dt.datetime(2026, 1, 5, 0, 59), "dropoff_datetime": dt.datetime(2026, 1, 5, 7, 1)},
        {"pickup_datetime": dt.datetime(2026, 1, 5, 0, 0), "dropoff_datetime": dt.datetime(2026, 1, 5, 6, 59)},
        {"trip_distance": 100.0, "passenger_count": 9, "total_amount": 500.01},
    )
    row = eda.atipicos_inconsistencias(df, YEAR).first()
    assert row.duracion_mayor_6h == 1
    assert row.distancia_mayor_100mi == 0 and row.pasajeros_mayor_8 == 1 and row.total_mayor_500 == 1
    assert "duracion_mayor_2h" in eda.atipicos_inconsistencias(df, YEAR, Umbrales(horas=2)).columns


def test_sample_is_repeatable_and_puts_nulls_last(trips):
    df = trips(
        *[{"fare_amount": float(i), "payment_type": None if i == 0 else 1} for i in range(7)],
        {"pickup_datetime": dt.datetime(2027, 1, 1)},
        {"dropoff_datetime": None, "fare_amount": -1.0},
    )
    fares = [r.fare_amount for r in explore.muestra_registros(df, YEAR, 5).collect()]
    assert sorted(fares) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_monthly_demand_by_active_and_calendar_day(trips):
    day = dt.datetime(2026, 2, 3, 9)
    df = trips(
        {"mes": 2, "pickup_datetime": day, "total_amount": -5.0},
        {"mes": 2, "pickup_datetime": day + dt.timedelta(hours=1), "total_amount": None},
        {"mes": 2, "pickup_datetime": day + dt.timedelta(days=2), "total_amount": 7.255},
    )
    assert rows_of(eda.evolucion_mensual(df, YEAR)) == [("yellow", 2, 3, 1.5, 7.26)]
    assert rows_of(indicators.demanda_mensual(df)) == [(dt.date(2026, 2, 1), "yellow", 3, 0.1)]
    leap = trips(*[{"anio": 2024, "mes": 2, "pickup_datetime": dt.datetime(2024, 2, 29)}] * 29)
    assert indicators.demanda_mensual(leap).first().viajes_por_dia == 1.0


def test_payment_shares(trips):
    df = trips(*[{"payment_type": p} for p in (1, 1, 0, None, 2)])
    assert rows_of(eda.formas_pago(df)) == [
        ("yellow", "no_informado", 2, 40.0),
        ("yellow", "tarjeta", 2, 40.0),
        ("yellow", "efectivo", 1, 20.0),
    ]
    labels = {r.forma_pago: r.viajes for r in indicators.pago_tarifa(df).collect()}
    assert labels == {"tarjeta": 2, "sin_dato (0)": 1, "otro": 1, "efectivo": 1}


def test_card_tips(trips):
    df = trips(
        {"tip_amount": 0.0, "fare_amount": 10.0},
        {"tip_amount": 3.0, "fare_amount": 10.0},
        {"tip_amount": -1.0},
        {"tip_amount": None},
        {"fare_amount": 0.0},
        {"payment_type": 2},
    )
    assert rows_of(eda.propinas_tarjeta(df)) == [("yellow", 2, 1.5, 1.5, 50.0, 15.0)]


def test_routes_drop_missing_ends_and_break_ties(trips):
    df = trips(
        *[{"origen_id": o, "destino_id": d} for o, d in [(5, 1), (5, 1), (2, 9), (2, 8), (None, 1), (1, None)]]
    )
    assert rows_of(eda.rutas_frecuentes(df, 2)) == [("yellow", 5, 1, 2), ("yellow", 2, 8, 1)]
    pairs = compare.fuente_normalizada(df)
    assert pairs.columns == list(compare.COMPARISON_COLUMNS)
    # Pairs with a missing end stay in the comparison report.
    assert compare.rutas_principales(pairs, None, 20).count() == 5


def test_annual_comparison_filters_means_only(trips):
    df = trips({"trip_distance": 0.0, "total_amount": 10.0}, {"trip_distance": 4.0, "total_amount": -10.0})
    assert rows_of(validate.comparacion_anual(df, [2026])) == [(2026, "yellow", 2, 4.0, 10.0)]
    assert validate.comparacion_anual(df, [2025]).count() == 0


def test_passenger_report_limits(trips):
    df = trips(*[{"passenger_count": p} for p in (0, 1, 6, 7, None)])
    assert [r.pasajeros for r in indicators.pasajeros_duracion(df).collect()] == [1, 6]


def test_request_origin_starts_with_the_first_named_month(trips):
    df = trips(
        {"mes": 5},
        {"mes": 6, "request_source": None, "fare_amount": 9.0},
        {"mes": 6, "request_source": "HV0003", "trip_distance": 4.0},
        {"mes": 7, "request_source": "HV0009"},
        {"mes": 7, "request_source": "HV0003", "fare_amount": 0.0},
        {"mes": 6, "request_source": "HV0005", "tipo_taxi": "green"},
    )
    # The month is found over all trips: here a green one names it first.
    everything = df.unionByName(trips({"mes": 6, "tipo_taxi": "green", "request_source": "HV0005"}))
    found = {r.origen: (r.viajes, r.pct_viajes) for r in indicators.origen_solicitud(df, everything).collect()}
    assert found == {"sin plataforma": (1, 33.33), "Uber": (1, 33.33), "otras plataformas": (1, 33.33)}
    nobody = trips({"mes": 6})
    assert indicators.origen_solicitud(nobody, nobody).count() == 0


def test_distance_bands_are_half_open(trips):
    df = trips(*[{"trip_distance": d} for d in (0.99, 1.0, 2.0, 5.0, 10.0, 20.0)])
    bands = [r.rango_distancia[:1] for r in indicators.propina_distancia(df).collect()]
    assert bands == ["1", "2", "3", "4", "5", "6"]


def test_rate_labels(trips):
    df = trips(*[{"ratecode_id": c} for c in (1, 2, 99, 7, None)])
    table = {r.tipo_tarifa: (r.viajes, r.pct_viajes) for r in indicators.tipo_tarifa(df).collect()}
    assert table == {"1 estandar": (1, 25.0), "2 JFK": (1, 25.0), "99 desconocida": (2, 50.0)}


def test_destinations_merge_labels_and_list_both_ends_once(spark, trips):
    zones = spark.createDataFrame(
        [(1, "Queens", "A"), (2, "Queens", "A"), (3, "Bronx", "B"), (4, "Bronx", "C"), (5, "X", "N/A"), (6, None, "D")],
        "zona_id int, barrio string, zona string",
    )
    tips = {1: 1.0, 2: 3.0, 3: 2.0, 4: 2.0, 5: 9.0, 6: 5.0, 7: 8.0}
    df = trips(*[{"destino_id": z, "tip_amount": t} for z, t in tips.items()])
    rows = rows_of(indicators.destino_propina(df, zones, min_trips=1, n=2))
    # A label with a NULL part is NULL, a group of its own; ties go by label.
    assert [r[:2] for r in rows] == [("mas alta", None), ("mas alta", "A (Queens)"), ("mas baja", "B (Bronx)")]
    assert len(rows_of(indicators.destino_propina(df, zones, min_trips=1, n=10))) == 4
    merged = next(r for r in rows if r[1] == "A (Queens)")
    assert merged[2:] == (2, 2.0, 20.0)
    few = rows_of(indicators.destino_propina(df, zones, min_trips=2, n=2))
    assert few == [("mas alta", "A (Queens)", 2, 2.0, 20.0)]


def test_hours_by_weekday(trips):
    df = trips(
        {"pickup_datetime": dt.datetime(2026, 1, 4, 23)},
        {"pickup_datetime": dt.datetime(2026, 1, 5, 0)},
        {"pickup_datetime": dt.datetime(2026, 1, 5, 1)},
    )
    assert rows_of(indicators.hora_dia_semana(df)) == [(0, "1 Lun", 1, 50.0), (1, "1 Lun", 1, 50.0), (23, "7 Dom", 1, 100.0)]
    profile = rows_of(eda.patron_horario(df, YEAR))
    assert ("yellow", "fin_semana", 23, 1, 100.0) in profile
    matrix = reshape.matriz_dia_hora(indicators.hora_dia_semana(df)).collect()
    assert len(matrix[0]) == 25 and matrix[0].h00 == 50.0 and matrix[0].h02 is None


def test_comparable_period(trips):
    df = trips(
        {"payment_type": 1, "tip_amount": 0.0, "cbd_congestion_fee": 0.75},
        {"payment_type": 1, "tip_amount": 1.0, "pickup_datetime": dt.datetime(2026, 1, 6)},
        {"payment_type": 2, "trip_distance": 0.0},
        {"mes": 9},
        {"tipo_taxi": "green", "total_amount": -1.0},
    )
    # Green has no plausible trip, so an inner join of both sides leaves it out.
    assert rows_of(evolution.comparacion_periodo(df, 360)) == [
        (2026, "yellow", 2.0, 10.0, 2.0, 10.0, 100.0, 50.0, 33.33)
    ]


def test_composition_without_cash_or_card(trips):
    df = trips({"payment_type": 0, "trip_distance": 4.0}, {"payment_type": 4, "duracion_min": 30.0, "trip_distance": 5.0})
    row = evolution.control_composicion(df).first()
    assert row.pct_tarjeta_vs_efectivo is None
    assert row.pct_sin_taximetro == 50.0 and row.distancia_mediana_sin_taximetro == 4.0
    assert row.mph_mediana_estandar == 17.0
    assert evolution.control_composicion(trips({"ratecode_id": None})).count() == 0


def test_record_kinds_per_active_day(trips):
    df = trips(
        {"payment_type": 0},
        {"payment_type": 0, "pickup_datetime": dt.datetime(2026, 1, 6)},
        {"payment_type": None},
        {"payment_type": 1},
    )
    assert rows_of(evolution.demanda_por_tipo_registro(df)) == [
        (2026, "con taximetro", 2.0, 50.0),
        (2026, "sin taximetro (codigo 0)", 1.0, 50.0),
    ]


def test_validity_forms_agree(trips):
    df = trips({}, {"trip_distance": 0.0}, {"tipo_taxi": "green", "trip_distance": None})
    left = rows_of(validate.resumen_validez(df, 360, "left"))
    assert left == [(2026, "green", 1, 0, 0.0), (2026, "yellow", 2, 1, 50.0)]
    assert rows_of(validate.resumen_validez(df, 360, "inner")) == left[1:]


def test_scenarios(trips):
    df = trips({"anio": 2024}, {"anio": 2024}, {"anio": 2026}, {"anio": 2025})
    assert rows_of(compare.volumen_por_escenario(df, [2024, 2026])) == [("2024", 2), ("2024+2026", 3), ("2026", 1)]
    assert rows_of(compare.volumen_por_escenario(df, [2025])) == [("2025", 1)]
    assert rows_of(compare.volumen_por(df)) == [(2024, 2), (2025, 1), (2026, 1)]


def test_reshaping(spark):
    df = spark.createDataFrame(
        [(dt.date(2026, 1, 1), "yellow", 5), (dt.date(2026, 4, 1), "yellow", 7), (dt.date(2026, 2, 1), "green", 1)],
        "fecha date, tipo_taxi string, v bigint",
    )
    full = rows_of(reshape.completar_meses(df, "fecha", ["tipo_taxi"]))
    assert len(full) == 8
    assert (dt.date(2026, 3, 1), "yellow", None) in full and (dt.date(2026, 4, 1), "yellow", 7) in full
    wide = rows_of(reshape.pivotar(df, "fecha", "tipo_taxi", "v", ("yellow", "green")))
    assert wide[0] == (dt.date(2026, 1, 1), 5, None)
    tied = spark.createDataFrame([("a", 1, 9), ("a", 2, 9), ("b", 1, None), ("b", 2, 1)], "g string, m int, v int")
    assert sorted(rows_of(reshape.fila_maxima(tied, ["g"], "v", [F.asc("m")]))) == [("a", 1, 9), ("b", 2, 1)]
    years = spark.createDataFrame([("a", 2024, 80.0), ("a", 2025, 100.0), ("b", 2025, 0.0)], "g string, y int, v double")
    index = evolution.indice_base(years, ["g"], "y", "v")
    assert sorted(r.indice for r in index.where("g = 'a'").collect()) == [100.0, 125.0]
    assert index.where("g = 'b'").first().indice is None
    assert rows_of(reshape.primeras_filas(years, [F.desc("v")], 1)) == [("a", 2025, 100.0)]


def test_record_watch_changes(trips):
    df = trips({"mes": 1, "payment_type": 0}, {"mes": 1}, {"mes": 2, "ratecode_id": None}, {"mes": 2, "ratecode_id": 99})
    first, second = evolution.vigilancia_registros(df).collect()
    assert first.cambio_pct_sin_taximetro is None
    assert second.cambio_pct_sin_taximetro == -50.0 and second.cambio_pct_tarifa_desconocida == 100.0
