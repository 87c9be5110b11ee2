"""Shared folder for tables a job writes and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else a warehouse that every executor reaches."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE_SETTING).rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_SETTING} is not set, and executors do not share the driver's {warehouse}")
    return warehouse


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_root(spark)}/milepost/{name}-{uuid.uuid4().hex}"
