"""Which files exist, whether they are complete, and which columns they carry.

The listing reads no file content. Footers and signatures are read inside tasks,
a few bytes per file, so a folder with a million files is checked by the cluster.
Two layouts are understood below a root folder:

* ``<service>/<year>/<service>_tripdata_YYYY-MM.parquet``
* ``tipo_taxi=<service>/anio=YYYY/mes=M/part-*.parquet``

A month split over several part files is one monthly file here.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.functions.labels import SERVICIOS
from milepost.sources.storage import open_file, storage_options

# Tasks get the functions below by value, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: first and last bytes of a Parquet file.
PARQUET_SIGNATURE = b"PAR1"


def _extract(text: Column, pattern: str) -> Column:
    """First group of ``pattern``, NULL instead of '' when it does not match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def service_of(path: Column, default: Column | str | None) -> Column:
    """Service named in the path, else ``default``."""
    chain = F.lit(default) if not isinstance(default, Column) else default
    for service in reversed(SERVICIOS):
        chain = F.when(path.contains(service), service).otherwise(chain)
    return chain


def year_of(path: Column) -> Column:
    text = F.coalesce(_extract(path, r"tripdata_(\d{4})-"), _extract(path, r"anio=(\d{4})(?:/|$)"))
    return text.try_cast("int")


def month_of(path: Column) -> Column:
    text = F.coalesce(_extract(path, r"-(\d{2})\.parquet$"), _extract(path, r"mes=(\d{1,2})(?:/|$)"))
    return text.try_cast("int")


def period_of(path: Column) -> Column:
    """``YYYY-MM`` or NULL."""
    partitioned = F.format_string("%04d-%02d", year_of(path), month_of(path))
    return F.coalesce(
        _extract(path, r"tripdata_(\d{4}-\d{2})"),
        F.when(year_of(path).isNotNull() & month_of(path).isNotNull(), partitioned),
    )


def _named_by_month(path: Column) -> Column:
    """The path ends in ``tripdata_YYYY-MM.parquet``."""
    return (F.substring(path, -24, 9) == "tripdata_") & (F.substring(path, -11, 1) == "-") & path.endswith(".parquet")


def year_of_record(path: Column) -> Column:
    """:func:`year_of` for use on every record: fixed positions from the end, no pattern search."""
    return F.when(_named_by_month(path), F.substring(path, -15, 4)).try_cast("int")


def month_of_record(path: Column) -> Column:
    return F.when(_named_by_month(path), F.substring(path, -10, 2)).try_cast("int")


def monthly_file_of(path: Column) -> Column:
    """Name of the monthly file a physical file belongs to."""
    partitioned = F.concat(service_of(path, ""), F.lit("_tripdata_"), period_of(path), F.lit(".parquet"))
    base_name = F.concat(F.regexp_extract(path, r"([^/]+)\.parquet$", 1), F.lit(".parquet"))
    return F.when(path.rlike(r"anio=\d{4}/mes=\d{1,2}/"), partitioned).otherwise(base_name)


def below_root(path: Column, root: str) -> Column:
    """The path below ``root``, so that folder names above it are never matched."""
    tail = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    return F.substring_index(path, tail, -1)


def _scan(spark: SparkSession, root: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
    )


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per physical file: ``ruta, relativa, bytes, modificado``. Spark leaves out empty files."""
    return _scan(spark, root).select(
        F.col("path").alias("ruta"),
        below_root(F.col("path"), root).alias("relativa"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modificado"),
    )


def monthly_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per monthly file: ``tipo_taxi, anio, mes, archivo, partes, bytes``.

    ``tipo_taxi``, ``anio`` and ``mes`` are NULL when the path does not tell them.
    """
    path = F.col("relativa")
    return (
        list_files(spark, root)
        .select(
            service_of(path, None).alias("tipo_taxi"),
            year_of(path).alias("anio"),
            month_of(path).alias("mes"),
            monthly_file_of(path).alias("archivo"),
            "bytes",
        )
        .groupBy("tipo_taxi", "anio", "mes", "archivo")
        .agg(F.count(F.lit(1)).alias("partes"), F.sum("bytes").alias("bytes"))
    )


def _spread(files: DataFrame) -> DataFrame:
    """Files dealt out by number: opening one costs the same whatever its size."""
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism)


def opened(path: str, options: dict[str, str]) -> tuple[bool, int | None, str | None, list[tuple] | None]:
    """Signature, record count, problem and ``posicion, columna, tipo`` of one file, from a few bytes of it."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    valid, length = False, len(PARQUET_SIGNATURE)
    try:
        with open_file(path, options) as handle:
            size = handle.size()
            if size >= 2 * length:
                ends = handle.read_at(length, 0), handle.read_at(length, size - length)
                valid = ends == (PARQUET_SIGNATURE, PARQUET_SIGNATURE)
            footer = pq.read_metadata(handle)
            schema = footer.schema.to_arrow_schema()
    except (OSError, pa.ArrowException) as problem:
        if not _is_broken(problem):
            raise
        return valid, None, str(problem)[:500], None
    return valid, footer.num_rows, None, [(i, field.name, _spark_type(field.type)) for i, field in enumerate(schema)]


def monthly_file_status(spark: SparkSession, root: str) -> DataFrame:
    """``tipo_taxi, anio, mes, archivo, valido``: a month is valid when all its parts are."""
    from milepost.sources.footer_source import read_footers

    path = F.col("relativa")
    return (
        read_footers(spark, root)
        .groupBy(
            service_of(path, None).alias("tipo_taxi"),
            year_of(path).alias("anio"),
            month_of(path).alias("mes"),
            monthly_file_of(path).alias("archivo"),
        )
        .agg(F.bool_and("valido").alias("valido"))
    )


def _spark_type(arrow_type) -> str:
    import pyarrow.types as pt

    if pt.is_timestamp(arrow_type):
        return "timestamp_ntz" if arrow_type.tz is None else "timestamp"
    if pt.is_string(arrow_type) or pt.is_large_string(arrow_type):
        return "string"
    if pt.is_dictionary(arrow_type):
        return _spark_type(arrow_type.value_type)
    if pt.is_decimal(arrow_type):
        return f"decimal({arrow_type.precision},{arrow_type.scale})"
    # Arrow names and the Spark SQL names of the same types.
    known = {
        "bool": "boolean",
        "int8": "tinyint",
        "int16": "smallint",
        "int32": "int",
        "int64": "bigint",
        "float": "float",
        "double": "double",
        "date32[day]": "date",
        "binary": "binary",
        "null": "void",
    }
    return known.get(str(arrow_type), str(arrow_type))


FOOTER_COLUMNS = "ruta string, relativa string, posicion int, columna string, tipo string, registros long, error string"


def _is_broken(problem: Exception) -> bool:
    """The bytes are no Parquet footer; any other failure to read them is one of the store."""
    import pyarrow as pa

    return isinstance(problem, pa.ArrowInvalid) or (isinstance(problem, OSError) and problem.errno is None)


def all_footers(files: DataFrame) -> DataFrame:
    """:func:`footers` with the file's ``registros``; a file whose footer is broken has one row with ``error`` alone.

    A file that cannot be read for another reason, such as a missing right or a store that does not
    answer, ends the query: it must not be taken for one without records.
    """
    options = storage_options(files.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, relative in zip(batch["ruta"], batch["relativa"]):
                _, records, problem, columns = opened(path, options)
                # A file without columns has a row all the same.
                for column in columns or [(None, None, None)]:
                    rows.append((path, relative, *column, records, problem))
            names = ["ruta", "relativa", "posicion", "columna", "tipo", "registros", "error"]
            yield pd.DataFrame(rows, columns=names).astype({"posicion": "Int32", "registros": "Int64"})

    return _spread(files.select("ruta", "relativa")).mapInPandas(read, FOOTER_COLUMNS)


def footers(files: DataFrame) -> DataFrame:
    """One row per readable file and column: ``ruta, relativa, posicion, columna, tipo``.

    Only the footer of each file is read, inside a task.
    """
    return all_footers(files).where(F.col("error").isNull()).drop("registros", "error")


def rejected_files(files: DataFrame) -> DataFrame:
    """``ruta, relativa, error`` of the files whose footer cannot be read."""
    return all_footers(files).where(F.col("error").isNotNull()).select("ruta", "relativa", "error")
