"""Read files of one service whose schemas differ over time.

Columns may be missing, change case, or change type between files. Merging
schemas fails on type changes, and a declared schema fails on files that store
another type. So files are grouped by the types they really store, each group is
read with its own declared schema, and the groups are cast to one contract and
unioned. There are as many groups as type variants (usually one to three), so the
plan stays small for any number of files. A file whose footer cannot be read is set
aside, as if it were not there; :func:`milepost.sources.inventory.rejected_files` names it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.sources.inventory import all_footers, service_of

FILE_PATH = "_ruta"


Variant = tuple[tuple[str, str], ...]


def _type_variants(
    footers: DataFrame, contracts: Mapping[str, Mapping[str, str]], whole_folders: bool
) -> dict[tuple[str, Variant], list[str]]:
    """Files or folders per ``(service, types that differ from the contract)``, from rows per file and column.

    Only metadata reaches the driver, one row per folder with uniform files; Spark's own
    file index for the same read holds more.
    """
    expected = {name.lower(): kind for contract in contracts.values() for name, kind in contract.items()}
    kinds = F.create_map(*[F.lit(x) for item in expected.items() for x in item])
    name = F.lower("columna")
    differs = name.isin(*expected) & (F.col("tipo") != kinds[name])
    service = service_of(F.col("relativa"), "")
    per_file = (
        footers.where(service.isin(*contracts))
        .groupBy("ruta", "relativa", service.alias("servicio"))
        .agg(
            F.sort_array(F.collect_list(F.when(differs, F.struct(name.alias("columna"), "tipo")))).alias("variante"),
            F.bool_and(F.col("error").isNull()).alias("legible"),
        )
    )
    readable = per_file.where("legible").select("servicio", "variante", "ruta")
    units = _folders_or_files(per_file) if whole_folders else readable
    variants: dict[tuple[str, Variant], list[str]] = {}
    for row in units.collect():
        stored = tuple((x.columna, x.tipo) for x in row.variante)
        variants.setdefault((row.servicio, stored), []).append(row.ruta)
    return variants


def _folders_or_files(per_file: DataFrame) -> DataFrame:
    """A folder named after one service stands for its files when all are readable and store the same types."""
    folder, last = F.regexp_replace("ruta", r"/[^/]+$", ""), F.regexp_replace("relativa", r"[^/]+$", "")
    placed = per_file.withColumns({"carpeta": folder, "propia": last.contains(F.col("servicio"))})
    folders = placed.groupBy("carpeta").agg(
        (F.bool_and(F.col("propia") & F.col("legible")) & (F.count_distinct("servicio", "variante") == 1)).alias("uniforme"),
        F.min("servicio").alias("servicio"),
        F.min("variante").alias("variante"),
    )
    uniform = folders.where("uniforme").select("servicio", "variante", F.col("carpeta").alias("ruta"))
    mixed = placed.where("legible").join(folders.where(~F.col("uniforme")).select("carpeta"), "carpeta", "left_semi")
    return uniform.unionByName(mixed.select("servicio", "variante", "ruta"))


def _read_variant(
    spark: SparkSession, base: str, paths: list[str], contract: Mapping[str, str], stored: Mapping[str, str]
) -> DataFrame:
    declared, columns = [], []
    for name, kind in contract.items():
        actual = stored.get(name.lower(), kind)
        if actual == "void":
            columns.append(F.lit(None).cast(kind).alias(name))
            continue
        declared.append(f"`{name}` {actual}")
        columns.append(F.col(name).cast(kind).alias(name))
    df = (
        spark.read.schema(", ".join(declared))
        .option("basePath", base)
        .option("pathGlobFilter", "*.parquet")
        .parquet(*paths)
    )
    partitions = [c for c in df.columns if c not in contract]
    return df.select(*columns, *partitions, F.col("_metadata.file_path").alias(FILE_PATH))


def read_with_contracts(
    spark: SparkSession,
    base: str,
    files: DataFrame,
    contracts: Mapping[str, Mapping[str, str]],
    whole_folders: bool = True,
    footers: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Read ``files`` (``ruta, relativa``) as the columns and types of their service's contract.

    ``footers`` are the files' footers if they are known (:class:`FooterCatalogue`); else they are opened.

    Returns one DataFrame per service found. Missing columns are typed NULLs; partition folders
    below ``base`` become columns; ``_ruta`` is the file each row came from. Pass
    ``whole_folders=False`` when ``files`` are not all files of their folders.
    """
    read: dict[str, DataFrame] = {}
    for (service, variant), paths in sorted(_type_variants(all_footers(files) if footers is None else footers, contracts, whole_folders).items()):
        part = _read_variant(spark, base, sorted(paths), contracts[service], dict(variant))
        read[service] = read[service].unionByName(part, allowMissingColumns=True) if service in read else part
    if not read:
        raise FileNotFoundError(f"no monthly files to read below {base}")
    return read
