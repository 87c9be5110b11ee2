"""Footers and signatures of Parquet files as a data source: ``spark.read.format("parquet_footers").load(root)``.

A row per file, empty files too. The folder is listed when the query is planned; files that a
filter on their names rules out are never opened, and the others are opened in tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from milepost.sources import inventory
from milepost.sources.storage import locate, storage_options

# Tasks get the classes below by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(inventory)

NAME = "parquet_footers"
SCHEMA = (
    "ruta string, relativa string, bytes long, valido boolean, registros long, error string, "
    "columnas array<struct<posicion:int,columna:string,tipo:string>>"
)
PUSHDOWN_SETTING = "spark.sql.python.filterPushdown.enabled"
#: Files per task, by default.
FILES_PER_TASK = 64


@dataclass
class Files(InputPartition):
    """``path to open, name below the root, bytes`` of the files of one task."""

    files: tuple[tuple[str, str, int], ...]


def name_test(condition: Filter):
    """The filter as a test of a file's name; None if it is about something else."""
    if getattr(condition, "attribute", None) != ("relativa",):
        return None
    tests = {
        EqualTo: lambda name: name == condition.value,
        In: lambda name: name in condition.value,
        StringStartsWith: lambda name: name.startswith(condition.value),
        StringContains: lambda name: condition.value in name,
        StringEndsWith: lambda name: name.endswith(condition.value),
    }
    return tests.get(type(condition))


class FooterReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options
        self.tests = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            test = name_test(condition)
            if test is None:
                yield condition
            else:
                self.tests.append(test)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        root = self.options["path"].rstrip("/")
        system, inner = locate(root, self.options)
        found = system.get_file_info(fs.FileSelector(inner, recursive=True))
        names = sorted(
            (f.path[len(inner) :].lstrip("/"), f.size) for f in found if f.is_file and f.base_name.endswith(".parquet")
        )
        chosen = [(f"{root}/{name}", name, size) for name, size in names if all(test(name) for test in self.tests)]
        step = int(self.options.get("filespertask", FILES_PER_TASK))
        # An empty folder is one empty task.
        return [Files(tuple(chosen[i : i + step])) for i in range(0, max(len(chosen), 1), step)]

    def read(self, partition: Files) -> Iterator[tuple]:
        for path, name, size in partition.files:
            yield (path, name, size, *inventory.opened(path, self.options))


class FooterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return FooterReader(dict(self.options))


def read_footers(spark: SparkSession, root: str) -> DataFrame:
    """``ruta, relativa, bytes, valido, registros, error, columnas`` of every Parquet file below ``root``.

    ``valido`` says that a file begins and ends with the Parquet signature; ``error`` says why a footer cannot be read.
    """
    spark.dataSource.register(FooterSource)
    # Without this Spark refuses a source that takes filters.
    spark.conf.set(PUSHDOWN_SETTING, "true")
    return spark.read.format(NAME).options(**storage_options(spark)).load(root)
