"""What the footers of a folder's files say, kept in a table and read again only where files changed.

A file is known by its name, size and time. A refresh lists the folder, opens the footers of new and
changed files in tasks, drops files that are gone, and commits the rest as a new version. Schemas,
type variants and record counts are then read from the table: no file is opened and no record scanned.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.plans.versions import VersionedTable
from milepost.plans.workspace import new_folder
from milepost.sources.inventory import all_footers, list_files

CATALOGUE = (
    "ruta string, relativa string, bytes long, modificado timestamp, registros long, error string, "
    "columnas array<struct<posicion:int,columna:string,tipo:string>>"
)
IDENTITY = ["relativa", "bytes", "modificado"]


class FooterCatalogue:
    """The footers of the files below ``root``, kept at ``path`` (by default for this session only)."""

    def __init__(self, spark: SparkSession, root: str, path: str | None = None) -> None:
        self.spark, self.root = spark, root
        self.table = VersionedTable(spark, path or new_folder(spark, "catalogo"), CATALOGUE)

    def refresh(self) -> int:
        """Bring the table up to date; returns how many footers were opened."""
        listing = list_files(self.spark, self.root)
        current = self.table.current()
        if current is None:
            self.table.replace(_rows(listing))
            return self.table.read().count()
        known = self.table.read(current)
        new = listing.join(known, IDENTITY, "left_anti")
        gone = known.join(listing, IDENTITY, "left_anti")
        opened = new.count()
        if opened or not gone.isEmpty():
            self.table.replace(known.join(listing.select(*IDENTITY), IDENTITY, "left_semi").unionByName(_rows(new)))
        return opened

    @cached_property
    def files(self) -> DataFrame:
        """One row per file as of the first use: ``ruta, relativa, bytes, modificado, registros, error, columnas``."""
        self.refresh()
        return self.table.read()

    def footers(self) -> DataFrame:
        """One row per readable file and column: ``ruta, relativa, posicion, columna, tipo``."""
        return self.files.where("error IS NULL").select("ruta", "relativa", F.inline("columnas"))

    def counts(self) -> DataFrame:
        """``relativa, registros`` of every readable file that holds records."""
        return self.files.where("error IS NULL AND registros > 0").select("relativa", "registros")

    def rejected(self) -> DataFrame:
        """``ruta, relativa, error`` of the files whose footer is broken."""
        return self.files.where("error IS NOT NULL").select("ruta", "relativa", "error")


def _rows(files: DataFrame) -> DataFrame:
    columns = F.sort_array(F.collect_list(F.when(F.col("columna").isNotNull(), F.struct("posicion", "columna", "tipo"))))
    read = all_footers(files).groupBy("ruta").agg(
        F.max("registros").alias("registros"), F.max("error").alias("error"), columns.alias("columnas")
    )
    return files.join(read, "ruta").select("ruta", *IDENTITY, "registros", "error", "columnas")
