"""Session settings the reports are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Trip timestamps carry no zone; UTC keeps any implicit cast neutral.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits the fact side of a join when one key holds much of the table.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits hot months when tables are written with a rebalance hint.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every column expression takes longer than a small report.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "milepost", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session. ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
