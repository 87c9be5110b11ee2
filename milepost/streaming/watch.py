"""An alert for each month that differs from the one before, given once.

The stream carries one summary per service and month. What is remembered of a service, its last
month's shares and columns, is the state of a streaming query: it survives restarts with the
checkpoint, and a summary that is read again, or published again, alerts nobody a second time.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Tasks get the functions below by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARES = ("pct_sin_taximetro", "pct_tarifa_desconocida")
SUMMARY = "tipo_taxi string, fecha date, pct_sin_taximetro double, pct_tarifa_desconocida double, columnas array<string>"
ALERT = "tipo_taxi string, fecha date, medida string, valor double, cambio double, columna string"
STATE = "fecha date, pct_sin_taximetro double, pct_tarifa_desconocida double, columnas array<string>"
# What an alert is about.
NEW_COLUMN, LOST_COLUMN = "columna nueva", "columna ausente"


def _follows(month: dt.date, before: dt.date) -> bool:
    return (month.year, month.month) == (before.year + before.month // 12, before.month % 12 + 1)


def _compared(key: str, row, last: tuple, limit: float) -> Iterator[tuple]:
    """The alerts of a month against the calendar month before."""
    for position, name in enumerate(SHARES, 1):
        now, then = getattr(row, name), last[position]
        if pd.notna(now) and then is not None and abs(round(now - then, 2)) > limit:
            yield key, row.fecha, name, now, round(now - then, 2), None
    here, there = (None if x is None else set(x) for x in (row.columnas, last[3]))
    if here is not None and there is not None:
        yield from ((key, row.fecha, NEW_COLUMN, None, None, c) for c in sorted(here - there))
        yield from ((key, row.fecha, LOST_COLUMN, None, None, c) for c in sorted(there - here))


def alerts(summaries: DataFrame, limit: float) -> DataFrame:
    """``tipo_taxi, fecha, medida, valor, cambio, columna`` of a stream of summaries.

    A share that moves by more than ``limit`` points, or a column that appears or disappears, is an
    alert of its month. Months are taken in order; one that is not later than the last, because it
    came late or again, is passed over. After a gap there is nothing to compare with.
    """

    def judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        found: list[tuple] = []
        rows = pd.concat(list(batches)).sort_values("fecha").drop_duplicates("fecha", keep="last")
        for row in rows.itertuples(index=False):
            if last is not None and row.fecha <= last[0]:
                continue
            if last is not None and _follows(row.fecha, last[0]):
                found += _compared(key[0], row, last, limit)
            shares = (None if pd.isna(getattr(row, s)) else float(getattr(row, s)) for s in SHARES)
            last = (row.fecha, *shares, None if row.columnas is None else list(row.columnas))
        state.update(last)
        names = [part.split()[0] for part in ALERT.split(", ")]
        yield pd.DataFrame(found, columns=names)

    return summaries.groupBy("tipo_taxi").applyInPandasWithState(
        judge, ALERT, STATE, "append", GroupStateTimeout.NoTimeout
    )


def watch(spark: SparkSession, summaries: str, found: str, checkpoint: str, limit: float = 5.0) -> DataFrame:
    """Judge the summaries below ``summaries`` that are new, add their alerts to ``found``, and return all alerts."""
    stream = spark.readStream.schema(SUMMARY).parquet(summaries)
    query = (
        alerts(stream, limit)
        .writeStream.format("parquet")
        .option("path", found)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(ALERT).parquet(found)


def summarise(months: DataFrame, footers: DataFrame | None = None) -> DataFrame:
    """Summaries from monthly shares (``vigilancia_registros``) and the files' columns (``tipo_taxi, fecha, columna``)."""
    shares = months.select("tipo_taxi", "fecha", *[F.col(s).cast("double").alias(s) for s in SHARES])
    if footers is None:
        return shares.withColumn("columnas", F.lit(None).cast("array<string>"))
    columns = footers.groupBy("tipo_taxi", "fecha").agg(F.sort_array(F.collect_set("columna")).alias("columnas"))
    return shares.join(columns, ["tipo_taxi", "fecha"], "left")


def alerts_per_service(alerts: DataFrame, months: DataFrame) -> DataFrame:
    """``tipo_taxi, medida, alertas, ultima`` of every service and share, those without an alert too."""
    every = months.select("tipo_taxi").distinct().select("tipo_taxi", F.explode(F.array(*map(F.lit, SHARES))).alias("medida"))
    given = alerts.groupBy("tipo_taxi", "medida").agg(F.count("*").alias("alertas"), F.max("fecha").alias("ultima"))
    both = every.join(given, ["tipo_taxi", "medida"], "left").fillna(0, ["alertas"])
    return both.orderBy("tipo_taxi", "medida")
