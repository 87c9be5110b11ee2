"""Saved tables: the normalised trips, written once and read many times."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.plans.model import PLAUSIBLE_COLUMNS, VIAJES, plausible, plausible_sql
from milepost.plans.workspace import new_folder

PARTITIONS = ("tipo_taxi", "anio")


def write_trips(trips: DataFrame, path: str, years: Iterable[int] | None = None) -> str:
    """Write ``viajes`` to ``path``, one folder per service and year, sorted inside.

    The rebalance hint shuffles by month and lets Spark split a month that is too large for
    one task and merge small ones. Sorting by month and pickup keeps the row-group ranges of
    both narrow. ``path`` should be new: readers of an older version keep it until they move.
    """
    if years is not None:
        trips = trips.where(F.col("anio").isin(*years))
    (
        trips.hint("rebalance", *PARTITIONS, "mes")
        .sortWithinPartitions(*PARTITIONS, "mes", "pickup_datetime")
        .write.mode("errorifexists")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )
    return path


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by :func:`write_trips` with its declared schema."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in VIAJES.items())
    return spark.read.schema(ddl).parquet(path).select(*VIAJES)


# Key that orders and line items are joined by, in each table.
BUCKET_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def write_buckets(spark: SparkSession, sf_dir: str, name: str, buckets: int) -> None:
    """Database ``name`` with the orders and the line items in ``buckets`` by their order, sorted inside.

    Written once, it takes the shuffle and the sort out of every later join of the two. A bucket
    should fit a task: at 100 TB that is some 100,000.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{new_folder(spark, name)}'")
    for table, key in BUCKET_KEYS.items():
        (
            spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
            .repartition(buckets, key)
            .write.mode("overwrite")
            .bucketBy(buckets, key)
            .sortBy(key)
            .saveAsTable(f"`{name}`.{table}")
        )


def publish_views(viajes: DataFrame, zonas: DataFrame | None = None, max_minutes: float = 360) -> None:
    """Register ``viajes``, ``viajes_validos`` and ``zonas`` for ``spark.sql``."""
    viajes.createOrReplaceTempView("viajes")
    viajes.where(plausible(max_minutes)).createOrReplaceTempView("viajes_validos")
    if zonas is not None:
        zonas.createOrReplaceTempView("zonas")


def publish_database(
    spark: SparkSession, name: str, trips_path: str, zonas: DataFrame | None = None, max_minutes: float = 360
) -> None:
    """Catalog database over a saved table: ``viajes``, ``viajes_validos`` and ``zonas``.

    Readers may ``USE`` it while a newer table is written elsewhere; publishing again points
    the names to the newer one.
    """
    root = new_folder(spark, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{root}'")
    columns = ", ".join(f"CAST({column} AS {kind}) AS {column}" for column, kind in VIAJES.items())
    # Views are replaced in one step: a reader finds the older table or the newer one.
    spark.sql(f"CREATE OR REPLACE VIEW `{name}`.viajes AS SELECT {columns} FROM parquet.`{trips_path}`")
    spark.sql(
        f"CREATE OR REPLACE VIEW `{name}`.viajes_validos AS SELECT * FROM `{name}`.viajes "
        f"WHERE {plausible_sql(max_minutes)}"
    )
    if zonas is not None:
        folder = new_folder(spark, "zonas")
        zonas.write.parquet(folder)
        spark.sql(f"CREATE OR REPLACE VIEW `{name}`.zonas AS SELECT * FROM parquet.`{folder}`")


def with_plausible_columns(columns: Iterable[str]) -> list[str]:
    return list(dict.fromkeys([*columns, *PLAUSIBLE_COLUMNS]))
