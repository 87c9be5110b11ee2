"""Small reshaping of report results, as DataFrame steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivotar(df: DataFrame, index: str, column: str, value: str, values: Sequence) -> DataFrame:
    """Long to wide with a known list of columns, so no extra pass looks for them."""
    return df.groupBy(index).pivot(column, list(values)).agg(F.first(value, ignorenulls=True)).orderBy(index)


def completar_meses(df: DataFrame, date: str, keys: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """One row per month between the first and last of ``df`` and per key; gaps stay NULL.

    ``known`` may give the months and keys of ``df`` in a cheaper way than computing ``df``.
    """
    listed = (df if known is None else known).groupBy(*keys).agg(F.min(date).alias("desde"), F.max(date).alias("hasta"))
    every = Window.partitionBy(F.lit(0))
    # One row per key: its months are a sequence between the edges over all keys.
    months = F.sequence(F.min("desde").over(every), F.max("hasta").over(every), F.expr("interval 1 month"))
    calendar = listed.select(*keys, months.alias("meses")).select(*keys, F.explode("meses").alias(date))
    others = [c for c in df.columns if c not in {date, *keys}]
    return calendar.join(df, [*keys, date], "left").select(date, *keys, *others).orderBy(date, *keys)


def fila_maxima(df: DataFrame, group: Sequence[str], measure: str, tiebreak: Sequence[Column]) -> DataFrame:
    """The row with the highest ``measure`` per group; ``tiebreak`` says which one wins a tie."""
    window = Window.partitionBy(*group).orderBy(F.col(measure).desc_nulls_last(), *tiebreak)
    return df.withColumn("_puesto", F.row_number().over(window)).where("_puesto = 1").drop("_puesto")


def primeras_filas(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of the ordered result."""
    return df.orderBy(*order).limit(n)


def matriz_dia_hora(hours: DataFrame, value: str = "pct_del_dia") -> DataFrame:
    """Weekday by hour matrix with one column per hour."""
    wide = pivotar(hours, "dia_semana", "hora", value, range(24))
    return wide.withColumnsRenamed({str(h): f"h{h:02d}" for h in range(24)})
