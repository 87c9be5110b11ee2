"""Hot keys: one order, month or service holding much of the data."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from milepost.operators import eda
from milepost.plans import tables
from milepost.plans.model import VIAJES
from milepost.plans.trip_source import StarTrips
from milepost.registry import REPORTS
from tests.conftest import DEFAULT_TRIP


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {key.replace("__", "."): value for key, value in conf.items()}
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def write_star(spark, folder, n=90_000):
    """A third of the line items belong to order 0, another third to supplier 0."""
    rows = spark.range(0, n, 1, 8)
    order = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    supplier = F.when(F.col("id") % 3 == 1, 0).otherwise(F.col("id") % 40)
    start = F.lit("1998-01-05").cast("timestamp_ntz")
    lineitem = rows.select(
        order.cast("long").alias("l_orderkey"),
        supplier.cast("long").alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        (F.rand(1) * 1e5).alias("l_extendedprice"),
        (F.col("id") % 10 / 100.0).alias("l_discount"),
        F.lit(0.05).alias("l_tax"),
        F.lit("A").alias("l_returnflag"),
        F.when(F.col("id") % 100 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.lit("1998-02-05").cast("timestamp_ntz").alias("l_shipdate"),
    )
    orders = spark.range(5000).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 100).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        start.alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    customer = spark.range(100).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"))
    supplier = spark.range(40).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).cast("int").alias("s_nationkey"))
    for name, df in (("lineitem", lineitem), ("orders", orders), ("customer", customer), ("supplier", supplier)):
        df.write.parquet(f"{folder}/{name}.parquet")
    return StarTrips(spark, str(folder))


def test_hot_join_keys_are_split(spark, tmp_path):
    source = write_star(spark, tmp_path)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32k",
        spark__sql__shuffle__partitions="16",
    ):
        df = source.trips("tipo_taxi", "pickup_datetime", "fare_amount").groupBy("tipo_taxi").agg(
            F.count("pickup_datetime").alias("n")
        )
        assert {r.tipo_taxi: r.n for r in df.collect()} == {"yellow": 89_100, "green": 900}
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        routes = REPORTS["q15_rutas_frecuentes"](source).collect()
        brute = (
            source.table("lineitem")
            .join(source.table("orders"), F.expr("l_orderkey = o_orderkey"))
            .groupBy("l_linestatus", (F.col("l_suppkey") % 25).alias("o"), (F.col("o_custkey") % 25).alias("d"))
            .count()
            .collect()
        )
        best = max((r["count"] for r in brute if r.l_linestatus == "O"))
        assert max(r.viajes for r in routes if r.tipo_taxi == "yellow") == best


def test_hot_month_is_written_by_several_tasks(spark, tmp_path):
    values = {**DEFAULT_TRIP, "pickup_datetime": None, "dropoff_datetime": None, "mes": 3}
    columns = [F.lit(values[name]).cast(kind).alias(name) for name, kind in VIAJES.items() if name != "fare_amount"]
    trips = spark.range(0, 400_000, 1, 8).select(*columns, F.rand(5).alias("fare_amount"))
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64k"):
        tables.write_trips(trips, str(tmp_path / "viajes"))
    written = list((tmp_path / "viajes" / "tipo_taxi=yellow" / "anio=2026").glob("*.parquet"))
    assert len(written) > 1
    saved = tables.read_trips(spark, str(tmp_path / "viajes"))
    assert saved.count() == 400_000
    assert saved.agg(F.count_distinct("fare_amount")).first()[0] == trips.agg(F.count_distinct("fare_amount")).first()[0]


def test_first_shuffle_of_a_profile_carries_one_row_per_group_and_task(spark, tmp_path):
    """99 % of the trips in one service cost no more than the rest."""
    source = write_star(spark, tmp_path)
    df = eda.formas_pago(source.trips("tipo_taxi", "payment_type"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("Exchange hashpartitioning(tipo_taxi")
    assert "partial_count(1)" in plan[first:]


def test_ranking_is_cut_before_its_shuffle(spark, tmp_path):
    source = write_star(spark, tmp_path)
    plan = REPORTS["q06_muestra_registros"](source)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_reports_start_no_job_and_read_the_source_twice_at_most(spark, tmp_path):
    """A sketch pass and a counting pass; months and base years are not computed with medians."""
    source = write_star(spark, tmp_path, n=3_000)
    spark.sparkContext.setJobGroup("build-reports", "build only")
    try:
        built = {
            name: REPORTS[name](source)
            for name in ("q10_caracteristicas_por_tipo", "q13_distribucion", "q25_pasajeros_duracion", "q28_origen_solicitud", "a13_indice_base")
        }
        # Opening a table reads its footer in a job of its own; no report aggregates.
        stages = [
            spark.sparkContext.statusTracker().getJobInfo(j) for j in spark.sparkContext.statusTracker().getJobIdsForGroup("build-reports")
        ]
        assert all(len(job.stageIds) == 1 for job in stages if job)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = built["a13_indice_base"]._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and plan.count("Relation [l_orderkey") == 1


def test_bucketed_tables_are_joined_where_they_lie(spark, tmp_path):
    source = write_star(spark, tmp_path, n=9_000)
    tables.write_buckets(spark, str(tmp_path), "estrella", 4)
    bucketed = StarTrips(spark, str(tmp_path), buckets="estrella")
    columns = ("anio", "tipo_taxi", "payment_type", "fare_amount", "pickup_datetime")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        def plan(trips):
            return trips.trips(*columns)._jdf.queryExecution().executedPlan().toString()

        assert plan(source).count("Exchange hashpartitioning") == 2
        assert "SortMergeJoin" in plan(bucketed) and "Exchange" not in plan(bucketed)
        assert plan(bucketed).count("Bucketed: true") == 2
        for name in ("q20_distribucion_pago", "q21_rutas_principales"):
            assert REPORTS[name](bucketed).collect() == REPORTS[name](source).collect()
        key = lambda r: tuple(map(str, r))
        assert sorted(bucketed.trips(*columns).collect(), key=key) == sorted(source.trips(*columns).collect(), key=key)
    spark.sql("DROP DATABASE estrella CASCADE")
