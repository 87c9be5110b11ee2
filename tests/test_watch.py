"""Alerts are given once."""

from __future__ import annotations

import datetime as dt

from milepost.streaming.watch import SUMMARY, watch

D = dt.date


def put(spark, path, *rows):
    spark.createDataFrame(list(rows), SUMMARY).coalesce(1).write.mode("append").parquet(path)


def test_each_month_alerts_once_over_runs_and_restarts(spark, tmp_path):
    summaries, found, control = (str(tmp_path / n) for n in ("summaries", "found", "control"))

    def run():
        rows = watch(spark, summaries, found, control, limit=5.0).collect()
        return sorted(((r.tipo_taxi, r.fecha.month, r.medida, r.cambio, r.columna) for r in rows), key=str)

    put(
        spark, summaries,
        ("yellow", D(2024, 1, 1), 1.0, 2.0, ["a", "b"]), ("yellow", D(2024, 2, 1), 9.0, 2.0, ["a", "b"]),
        ("green", D(2024, 1, 1), 50.0, None, None),
    )
    first = [("yellow", 2, "pct_sin_taximetro", 8.0, None)]
    assert run() == first
    # Nothing new, and a restart: the alert is not repeated.
    assert run() == first
    # The same month again, a late one, and the next one.
    put(
        spark, summaries,
        ("yellow", D(2024, 2, 1), 30.0, 2.0, ["a"]), ("yellow", D(2023, 12, 1), 99.0, 2.0, ["a"]),
        ("yellow", D(2024, 3, 1), 9.5, 8.0, ["a", "c"]), ("green", D(2024, 2, 1), 44.0, 3.0, ["x"]),
    )
    second = [
        ("green", 2, "pct_sin_taximetro", -6.0, None),
        *first,
        ("yellow", 3, "columna ausente", None, "b"),
        ("yellow", 3, "columna nueva", None, "c"),
        ("yellow", 3, "pct_tarifa_desconocida", 6.0, None),
    ]
    assert run() == sorted(second, key=str)
    # After a gap there is nothing to compare with; over a year's end there is.
    put(spark, summaries, ("yellow", D(2024, 12, 1), 90.0, 8.0, None), ("yellow", D(2025, 1, 1), 70.0, 8.0, None))
    third = [r for r in run() if r not in second]
    assert third == [("yellow", 1, "pct_sin_taximetro", -20.0, None)]
