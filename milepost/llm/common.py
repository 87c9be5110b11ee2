"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.plans.workspace import new_folder

#: A word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts lineage, survives lost executors, and gives the optimizer true sizes, so a later join
    broadcasts the table only if its files are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that a step writes for itself; all but those it hands over go when the step is done."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._paths = spark, []

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        """As :func:`saved`, for a table that nothing reads after this step."""
        path = new_folder(self._spark, name)
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        hadoop = self._spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(self._spark._jvm.org.apache.hadoop.fs.Path, self._paths):
            path.getFileSystem(hadoop).delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that mentions a column expression evaluates it again for each element; bound as a
    lambda variable it is evaluated once.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def only(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop every other column, so names that an operator adds cannot clash."""
    return df.select(*columns)
