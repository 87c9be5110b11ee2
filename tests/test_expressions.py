"""Rounding, date differences and labels, each on its own."""

from __future__ import annotations

import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from milepost.functions import labels
from milepost.functions.expressions import (
    exact_avg,
    exact_sum,
    exact_total,
    hours_crossed,
    is_weekend,
    iso_weekday,
    labelled,
    percent,
    percent_of_rows,
    rounded,
    seconds_between,
    sum_of_totals,
)


def test_rounding_works_on_the_scaled_double(spark):
    rng = random.Random(7)
    values = [0.285, 1.005, 2.675, -2.5, 0.5, -0.005, 1234.565] + [rng.randrange(10**7) / 1000 for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for value, shown in df.select("x", rounded(F.col("x"))).collect():
        scaled = value * 100.0
        wanted = math.copysign(math.floor(abs(scaled) + 0.5), scaled) / 100.0
        # floor(x + 0.5) itself errs when x + 0.5 is not representable
        if abs(abs(scaled) - math.floor(abs(scaled)) - 0.5) > 1e-9:
            assert shown == wanted, value
    first = {r[0]: r[1] for r in df.limit(7).select("x", rounded(F.col("x"))).collect()}
    assert first[0.285] == 0.28
    assert first[0.5] == 0.5
    assert spark.range(1).select(rounded(F.lit(-2.5), 0)).first()[0] == -3.0


def _span(spark, start, end, expression):
    df = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz")
    return df.select(expression(F.col("a"), F.col("b"))).first()[0]


def test_hours_count_boundaries(spark):
    day = dt.datetime(2026, 1, 5)
    assert _span(spark, day.replace(minute=59), day.replace(hour=7, minute=1), hours_crossed) == 7
    assert _span(spark, day.replace(hour=23), dt.datetime(2026, 1, 6, 1), hours_crossed) == 2
    assert _span(spark, dt.datetime(2026, 1, 6, 1), day.replace(hour=23), hours_crossed) == -2


def test_seconds_count_boundaries(spark):
    a = dt.datetime(2026, 1, 5, 0, 0, 0, 900_000)
    b = dt.datetime(2026, 1, 5, 0, 0, 1, 100_000)
    assert _span(spark, a, b, seconds_between) == 1
    assert _span(spark, b, a, seconds_between) == -1
    assert _span(spark, dt.datetime(2024, 2, 28), dt.datetime(2024, 3, 1), seconds_between) == 2 * 86400


def test_differences_ignore_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # This night has 23 hours in that zone.
        a, b = dt.datetime(2026, 3, 8, 0, 0), dt.datetime(2026, 3, 8, 6, 0)
        assert _span(spark, a, b, seconds_between) == 6 * 3600
        assert _span(spark, a, b, hours_crossed) == 6
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_weekdays(spark):
    sunday = dt.datetime(2026, 1, 4, 12)
    days = [(sunday + dt.timedelta(days=i),) for i in range(7)]
    df = spark.createDataFrame(days, "t timestamp_ntz")
    rows = df.select(iso_weekday(F.col("t")), is_weekend(F.col("t"))).collect()
    assert [r[0] for r in rows] == [7, 1, 2, 3, 4, 5, 6]
    assert [r[1] for r in rows] == [True] + [False] * 5 + [True]


def test_labels_and_shares(spark):
    df = spark.createDataFrame([(0,), (1,), (6,), (9,), (None,)], "c bigint")
    eda = [r[0] for r in df.select(labelled(F.col("c"), labels.FORMA_PAGO, labels.FORMA_PAGO_RESTO)).collect()]
    assert eda == ["no_informado", "tarjeta", "viaje_anulado", "no_informado", "no_informado"]
    fare = df.select(labelled(F.col("c"), labels.FORMA_PAGO_TARIFA, labels.FORMA_PAGO_TARIFA_RESTO)).collect()
    assert [r[0] for r in fare] == ["sin_dato (0)", "tarjeta", "otro", "otro", "otro"]
    # A NULL condition counts as not met.
    assert df.agg(percent_of_rows(F.col("c") > 0)).first()[0] == 60.0
    assert df.agg(percent(F.sum("c"), F.sum(F.lit(0)))).first()[0] is None


def test_exact_sums_match_decimals(spark):
    rng = random.Random(3)
    values = [rng.randrange(-(10**8), 10**8) / 100 * (rng.randrange(11) / 100) for _ in range(5_000)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    total = sum(Decimal(repr(v)).quantize(Decimal("0.000001"), ROUND_HALF_UP) for v in values if v is not None)
    shown = df.agg(exact_sum(F.col("x")), exact_avg(F.col("x"))).first()
    assert shown[0] == float(total)
    assert shown[1] == float(total) / 5_000
    assert df.where("x IS NULL").agg(exact_sum(F.col("x")), exact_avg(F.col("x"))).first() == (None, None)


def test_sums_take_values_that_are_no_amounts(spark):
    """As plain sums do: a value that is not a number stays one, a huge one is added."""
    rows = [("nan", 1.5), ("nan", float("nan")), ("huge", 1e20), ("huge", 2.25), ("usual", 0.1), ("usual", None), ("none", None)]
    table = spark.createDataFrame(rows, "k string, x double").groupBy("k").agg(
        exact_sum(F.col("x")).alias("s"), exact_avg(F.col("x")).alias("a"), F.sum("x").alias("p"), F.avg("x").alias("q")
    )
    for r in table.collect():
        assert str(r.s) == str(r.p) and str(r.a) == str(r.q), r.k


def test_totals_add_up(spark):
    rows = [(1, 0.1), (1, float("inf")), (2, 0.2), (2, None)]
    parts = spark.createDataFrame(rows, "k int, x double").groupBy("k").agg(exact_total(F.col("x")).alias("t"))
    assert parts.where("k = 2").agg(sum_of_totals("t").alias("s")).first().s == 0.2
    assert parts.agg(sum_of_totals("t").alias("s")).first().s == float("inf")
