"""Open files by the paths Spark uses, from inside tasks.

Spark reaches stores through Hadoop; footers and signatures are read with Arrow. The driver
takes what Arrow needs from the Hadoop configuration once, and tasks get it as a plain dict.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Tasks get the functions below by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Hadoop settings that say how to reach a store.
HADOOP_SETTINGS = (
    "fs.s3a.access.key",
    "fs.s3a.secret.key",
    "fs.s3a.session.token",
    "fs.s3a.endpoint",
    "fs.s3a.endpoint.region",
    "fs.s3a.connection.ssl.enabled",
    "fs.s3a.path.style.access",
    "fs.oss.accessKeyId",
    "fs.oss.accessKeySecret",
    "fs.oss.endpoint",
)


def storage_options(spark: SparkSession) -> dict[str, str]:
    """The settings of this session's Hadoop configuration that are set."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {name: conf.get(name) for name in HADOOP_SETTINGS}
    return {name: value for name, value in found.items() if value}


def _s3(options: dict[str, str], prefix: str, key: str, secret: str):
    from pyarrow import fs

    given = {
        "access_key": options.get(f"{prefix}.{key}"),
        "secret_key": options.get(f"{prefix}.{secret}"),
        "session_token": options.get(f"{prefix}.session.token"),
        "endpoint_override": options.get(f"{prefix}.endpoint"),
        "region": options.get(f"{prefix}.endpoint.region") or "us-east-1",
    }
    if options.get(f"{prefix}.connection.ssl.enabled") == "false":
        given["scheme"] = "http"
    if options.get(f"{prefix}.path.style.access") != "true" and given["endpoint_override"]:
        given["force_virtual_addressing"] = True
    return fs.S3FileSystem(**{name: value for name, value in given.items() if value})


def locate(path: str, options: dict[str, str]):
    """The Arrow file system of a path, and the path within it."""
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if not mark:
        return fs.LocalFileSystem(), path
    if scheme in ("s3", "s3a", "s3n"):
        return _s3(options, "fs.s3a", "access.key", "secret.key"), rest
    if scheme == "oss":
        return _s3(options, "fs.oss", "accessKeyId", "accessKeySecret"), rest
    if scheme == "dbfs":
        return fs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    if scheme in ("wasb", "wasbs", "abfs", "abfss"):
        container, _, tail = rest.partition("@")
        account, _, inner = tail.partition("/")
        return fs.AzureFileSystem(account.split(".")[0]), f"{container}/{inner}"
    if scheme in ("hdfs", "viewfs"):
        host, _, inner = rest.partition("/")
        return fs.HadoopFileSystem(f"{scheme}://{host}"), "/" + inner
    return fs.FileSystem.from_uri(path)


def open_file(path: str, options: dict[str, str]):
    system, inner = locate(path, options)
    return system.open_input_file(inner)
