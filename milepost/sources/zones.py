"""Lookup of zone ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: header of the lookup file.
ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """``zona_id, barrio, zona, service_zone`` from the CSV lookup."""
    raw = spark.read.csv(path, header=True, schema=ZONE_SCHEMA, enforceSchema=False)
    return raw.select(
        F.col("LocationID").alias("zona_id"),
        F.col("Borough").alias("barrio"),
        F.col("Zone").alias("zona"),
        "service_zone",
    )
