"""Column expressions shared by the reports.

Every expression is built from JVM-side functions, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Period = tuple[str, str]


def rounded(value: Column, digits: int = 2) -> Column:
    """Round half away from zero on the scaled double.

    ``F.round(x, 2)`` rounds the decimal text of the double (0.285 -> 0.29); the
    reports round the binary value (0.285 -> 0.28).
    """
    scale = F.lit(float(10**digits))
    return F.round(value * scale, 0) / scale


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from ``start`` to ``end``; no session zone involved."""
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("long")
    return days * 86400 + (_second_of_day(end) - _second_of_day(start))


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries crossed: 00:59 -> 07:01 is 7, not 6."""
    days = F.date_diff(F.to_date(end), F.to_date(start)).cast("long")
    return days * 24 + (F.hour(end) - F.hour(start))


def iso_weekday(ts: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(ts) + 1


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def in_period(ts: Column, period: Period) -> Column:
    """Half-open ``[lo, hi)``; a bare range, so it reaches the Parquet scan."""
    lo, hi = (F.lit(edge).cast("timestamp_ntz") for edge in period)
    return (ts >= lo) & (ts < hi)


def in_year(ts: Column, year: Column) -> Column:
    """A difference, as an equality of columns of two tables would become a key of their join."""
    return F.year(ts) - year == 0


def exact_total(value: Column) -> Column:
    """Sum of amounts with up to six decimals, as ``struct<exacto decimal, resto double>``.

    A sum of doubles changes in its last digits with the order tasks finish in, which flips
    rounded values that lie on a tie. Whole units and millionths are summed as two integers:
    exact, in any order, and without a decimal object per row. Values that are not numbers or
    from 1e12 up are summed apart as doubles. :func:`total_of` and :func:`sum_of_totals` read it.
    """
    usual = F.abs(value) < F.lit(1e12)
    amount = F.when(usual, value)
    whole = F.floor(amount)
    millionths = F.rint((amount - whole) * F.lit(1e6)).cast("long")
    exact = F.sum(whole).cast("decimal(20,0)") + F.sum(millionths).cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    return F.struct(exact.alias("exacto"), F.sum(F.when(~usual, value)).alias("resto"))


def _joined(exact: Column, rest: Column) -> Column:
    number = exact.cast("double")
    return F.when(rest.isNull(), number).otherwise(F.coalesce(number, F.lit(0.0)) + rest)


def total_of(total: Column) -> Column:
    """The sum held by an :func:`exact_total`."""
    return _joined(total["exacto"], total["resto"])


def sum_of_totals(name: str) -> Column:
    """The sum of a column of :func:`exact_total` values, as an aggregate."""
    return _joined(F.sum(F.col(name)["exacto"]), F.sum(F.col(name)["resto"]))


def exact_sum(value: Column) -> Column:
    return total_of(exact_total(value))


def exact_avg(value: Column) -> Column:
    return F.try_divide(exact_sum(value), F.count(value))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL when the denominator is zero."""
    return F.try_divide(F.lit(100.0) * part, whole.cast("double"))


def percent_of_rows(condition: Column, among: Column | None = None) -> Column:
    """Share of rows (of those in ``among``) meeting ``condition``; a NULL condition counts as not met."""
    met = F.when(condition, 1).otherwise(0)
    return F.lit(100.0) * F.avg(met if among is None else F.when(among, met))


def percent_within(df: DataFrame, value: str, keys: Sequence[str], name: str) -> DataFrame:
    """Add each row's share of its partition. ``df`` is an aggregate, one row per label."""
    whole = F.sum(value).over(Window.partitionBy(*keys))
    return df.withColumn(name, rounded(percent(F.col(value), whole)))


def labelled(code: Column, labels: Mapping, default: str) -> Column:
    """Translate codes; anything else, NULL included, gets ``default``."""
    known = iter(labels.items())
    key, text = next(known)
    chain = F.when(code == key, text)
    for key, text in known:
        chain = chain.when(code == key, text)
    return chain.otherwise(default)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per group. Spark cuts each task's rows to ``n`` before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_puesto", F.row_number().over(window)).where(F.col("_puesto") <= n).drop("_puesto")
