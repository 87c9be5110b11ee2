"""Time the headline reports; prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local threads. The three
comparison reports run from the source tables and from the saved table, the others from the saved
table; ``value`` is the sum of the best times. ``from_source`` has the same reports without a
saved table. Every report is run ``BENCH_RUNS`` times.
"""

from __future__ import annotations

import json
import os
import sys
import time

from milepost.plans.trip_source import StarTrips
from milepost.registry import REPORTS
from milepost.session import build_session

HEADLINE = (
    "q19_resumen_mensual",
    "q19_resumen_mensual_tabla",
    "q20_distribucion_pago",
    "q20_distribucion_pago_tabla",
    "q21_rutas_principales",
    "q21_rutas_principales_tabla",
    "q07_calidad_datos",
    "q08_evolucion_mensual",
    "q09_patron_horario",
    "q10_caracteristicas_por_tipo",
    "q13_distribucion",
    "q15_rutas_frecuentes",
    "q25_pasajeros_duracion",
    "q26_duracion_mensual",
    "q27_pago_tarifa",
    "q28_origen_solicitud",
    "q29_propina_distancia",
    "q30_tipo_tarifa",
    "q31_destino_propina",
    "q34_cargo_congestion",
    "q38_comparacion_enero_agosto",
    "q39_control_composicion",
    "q40_demanda_por_tipo_registro",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "milepost-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
    )
    source = StarTrips(spark, sf_dir)
    started = time.perf_counter()
    on_table = StarTrips(spark, sf_dir, table=source.saved_path)
    materialise = time.perf_counter() - started

    def timed(name: str, trips: StarTrips) -> list[float]:
        taken = []
        for _ in range(runs):
            started = time.perf_counter()
            REPORTS[name](trips).collect()
            taken.append(round(time.perf_counter() - started, 3))
        return taken

    chosen = sys.argv[1:] or HEADLINE
    taken = {name: timed(name, on_table) for name in chosen}
    first, times = {name: t[0] for name, t in taken.items()}, {name: min(t) for name, t in taken.items()}
    apart = [n for n in chosen if f"{n}_tabla" not in HEADLINE and not n.endswith("_tabla")]
    from_source = {name: min(timed(name, source)) for name in apart}
    ratios = sorted(
        times[name] / times[f"{name}_tabla"] for name in times if f"{name}_tabla" in times
    )
    print(
        json.dumps(
            {
                "metric": "headline_reports_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": first,
                "from_source": from_source,
                "materialise_sec": round(materialise, 3),
                "source_to_saved_ratio_median": round(ratios[len(ratios) // 2], 3) if ratios else None,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
