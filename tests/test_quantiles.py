"""Exact quantiles against a sorted list, in every path."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from milepost.functions.quantiles import grouped_medians, grouped_quantiles

PROBS = (0.0, 0.5, 0.9, 0.99, 1.0)


def interpolated(values, p):
    values = sorted(v for v in values if v is not None)
    if not values:
        return None
    position = (len(values) - 1) * p
    low, part = math.floor(position), position - math.floor(position)
    return values[low] * (1.0 - part) + values[math.ceil(position)] * part


def groups(seed=11, n=12_000):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        rows.append(("hot", rng.lognormvariate(2, 1), rng.randrange(7) * 1.0))
    for _ in range(300):
        rows.append(("warm", rng.uniform(-5, 5), None if rng.random() < 0.3 else -1.0))
    rows += [("one", 3.5, None), (None, 1.0, 2.0), (None, 2.0, 4.0)]
    rng.shuffle(rows)
    return rows


# At accuracy 10,000 no group is large enough for closed brackets; at 100 "hot" and "warm" have them.
@pytest.mark.parametrize("accuracy", [100, 1_000, 10_000])
@pytest.mark.parametrize("bounded", [True, False])
def test_matches_a_sorted_list(spark, accuracy, bounded):
    rows = groups()
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(6)
    table = grouped_quantiles(
        df,
        ["k"],
        {"qx": F.col("x"), "qy": F.col("y"), "qz": F.when(F.col("k") == "hot", -F.col("x"))},
        PROBS,
        aggs=[F.count(F.lit(1)).alias("n")],
        accuracy=accuracy,
        bounded_keys=bounded,
    )
    found = {r.k: r for r in table.collect()}
    assert set(found) == {"hot", "warm", "one", None}
    for key, row in found.items():
        xs = [x for k, x, _ in rows if k == key]
        ys = [y for k, _, y in rows if k == key]
        assert row.n == len(xs)
        assert list(row.qx) == [interpolated(xs, p) for p in PROBS]
        assert list(row.qy) == [interpolated(ys, p) for p in PROBS]
        zs = [-x for x in xs] if key == "hot" else []
        assert list(row.qz) == [interpolated(zs, p) for p in PROBS]


def test_bracketed_group_keeps_few_rows(spark):
    """The counting shuffle of a large group carries its bracket, not the group."""
    df = spark.range(60_000).select(F.lit("a").alias("k"), (F.hash("id") % 1_000_003).cast("double").alias("x"))
    table = grouped_medians(df, ["k"], {"m": F.col("x")}, accuracy=1000)
    values = [r.x for r in df.collect()]
    assert table.first().m == interpolated(values, 0.5)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def jobs_of(spark, group):
    return list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_building_starts_no_job(spark):
    """Neither a size probe nor a sketch runs before the report is asked for rows."""
    df = spark.range(1_000).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("x"))
    spark.sparkContext.setJobGroup("quantile-build", "build only")
    try:
        table = grouped_medians(df, ["k"], {"m": F.col("x")})
        assert jobs_of(spark, "quantile-build") == []
        table.collect()
        assert jobs_of(spark, "quantile-build") != []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_ranks_of_one_hot_group_are_counted_by_bins(spark):
    """No window orders a whole bracket: the values in order are those of the bins that hold a rank."""
    df = spark.range(0, 200_000, 1, 8).select(F.lit("hot").alias("k"), F.rand(3).alias("x"))
    table = grouped_medians(df, ["k"], {"m": F.col("x")}, accuracy=100)
    values = [r.x for r in df.collect()]
    assert table.first().m == interpolated(values, 0.5)
    plan = table._jdf.queryExecution().executedPlan().toString()
    ordered = [line for line in plan.splitlines() if "Window [" in line]
    assert ordered and all("bin" in line for line in ordered)


def test_heavy_ties_and_constant_groups(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 2).alias("k"), F.when(F.col("id") % 10 == 0, F.lit(1.0)).otherwise(2.0).alias("x")
    )
    found = {r.k: r.m for r in grouped_medians(df, ["k"], {"m": F.col("x")}, accuracy=200).collect()}
    assert found == {0: 2.0, 1: 2.0}


def test_no_rows(spark):
    df = spark.createDataFrame([], "k string, x double")
    assert grouped_medians(df, ["k"], {"m": F.col("x")}).count() == 0


def test_sketch_variant_is_close(spark):
    df = spark.range(50_000).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("x"))
    (row,) = grouped_quantiles(df, ["k"], {"q": F.col("x")}, (0.5, 0.99), exact=False).collect()
    assert row.q[0] == pytest.approx(25_000, rel=0.001)
    assert row.q[1] == pytest.approx(49_500, rel=0.001)
