"""Keep a normalised table in step with the monthly files that arrive.

The stream carries file names, not records: each micro-batch names new files. The months they
belong to are read again as a whole with the drift-safe batch reader and replace their
partitions in a new version of the table, so readers see a batch whole or not at all. A batch that
runs again, another batch size or a lost checkpoint adds no record twice. A month that was published again under the same
path is found by its size and time against the manifest, which also names the files set aside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.functions.labels import SERVICIOS
from milepost.plans.model import VIAJES, normalise_all, raw_contracts
from milepost.plans.versions import VersionedTable
from milepost.sources.drift import read_with_contracts
from milepost.sources.inventory import below_root, list_files, month_of, rejected_files, service_of, year_of

# Fixed value: schema of the file-listing source.
LISTING = "path string, modificationTime timestamp, length long, content binary"
PARTITIONS = ("tipo_taxi", "anio", "mes")
MANIFEST = "ruta string, relativa string, bytes long, modificado timestamp, rechazo string, tomado timestamp"
NO_SERVICE = "the name tells no known service"
NO_MONTH = "the name tells no month"


def _manifest_path(table: str) -> str:
    return f"{table.rstrip('/')}_archivos"


def trips_table(spark: SparkSession, table: str) -> VersionedTable:
    """The table that :func:`ingest_arrivals` keeps, with all its versions."""
    return VersionedTable(spark, table, ", ".join(f"{name} {kind}" for name, kind in VIAJES.items()), PARTITIONS)


def _placed(files: DataFrame) -> DataFrame:
    path = F.col("relativa")
    return files.withColumns(
        {"tipo_taxi": service_of(path, None), "anio": year_of(path), "mes": month_of(path)}
    )


def _take(spark: SparkSession, root: str, table: str, names: DataFrame) -> int:
    """Replace the months of ``names`` (``relativa``) by what their files hold now; how many files were named."""
    listing = _placed(list_files(spark, root))
    named = _placed(names.select("relativa").distinct())
    months = named.select(*[F.col(c).alias(f"_{c}") for c in PARTITIONS]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PARTITIONS]
    files = listing.join(F.broadcast(months), same[0] & same[1] & same[2], "left_semi").persist()
    try:
        readable = files.where(F.col("tipo_taxi").isin(*SERVICIOS) & F.col("anio").isNotNull() & F.col("mes").isNotNull())
        bad = rejected_files(readable).select("ruta", F.col("error").alias("rechazo")).persist()
        good = readable.join(bad, "ruta", "left_anti")
        # Service, year and month of the batch: a few values a year. A month whose files are all gone or bad is empty.
        named_months = [tuple(row) for row in months.dropna().collect()]
        if good.isEmpty():
            rows = spark.createDataFrame([], trips_table(spark, table).ddl)
        else:
            raw = read_with_contracts(spark, root, good.select("ruta", "relativa"), raw_contracts(), whole_folders=False)
            rows = normalise_all(raw).hint("rebalance", *PARTITIONS)
        if named_months:
            trips_table(spark, table).replace_partitions(rows, named_months)
        unnamed = F.when(~F.coalesce(F.col("tipo_taxi"), F.lit("")).isin(*SERVICIOS), NO_SERVICE).when(
            F.col("anio").isNull() | F.col("mes").isNull(), NO_MONTH
        )
        taken = files.join(bad, "ruta", "left").select(
            "ruta",
            "relativa",
            "bytes",
            "modificado",
            F.coalesce("rechazo", unnamed).alias("rechazo"),
            F.current_timestamp().alias("tomado"),
        )
        taken.coalesce(1).write.mode("append").parquet(_manifest_path(table))
        bad.unpersist()
        return named.count()
    finally:
        files.unpersist()


def _manifest(spark: SparkSession, table: str) -> DataFrame:
    """What is known of each file since it was last taken."""
    rows = spark.read.schema(MANIFEST).parquet(_manifest_path(table))
    latest = F.max_by(F.struct("bytes", "modificado", "rechazo"), "tomado").alias("visto")
    return rows.groupBy("relativa").agg(latest).select("relativa", "visto.*")


def _manifest_exists(spark: SparkSession, table: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(_manifest_path(table))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def ingest_arrivals(
    spark: SparkSession, root: str, table: str, checkpoint: str, files_per_batch: int = 1000
) -> int:
    """Ingest every file below ``root`` that is new or was published again; returns how many there were.

    Files that name no service or month, or whose footer cannot be read, are set aside and
    listed by :func:`read_rejected`; the others go on.
    """
    counts: list[int] = []
    if _manifest_exists(spark, table):
        known = _manifest(spark, table).select("relativa", F.col("bytes").alias("antes"), F.col("modificado").alias("hora"))
        changed = (
            list_files(spark, root)
            .join(known, "relativa")
            .where((F.col("bytes") != F.col("antes")) | (F.col("modificado") != F.col("hora")))
            .select("relativa")
            .persist()
        )
        if not changed.isEmpty():
            counts.append(changed.count())
            _take(spark, root, table, changed)
        changed.unpersist()
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(LISTING)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        # A file may keep an old modification time when it is copied in late.
        .option("maxFileAge", "36500d")
        .load(root)
        .select(below_root(F.col("path"), root).alias("relativa"))
    )

    def append(batch: DataFrame, batch_id: int) -> None:
        names = batch.persist()
        if not names.isEmpty():
            counts.append(_take(spark, root, table, names))
        names.unpersist()

    query = (
        arrivals.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(counts)


def read_ingested(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The table written by :func:`ingest_arrivals`, by default its latest version."""
    return trips_table(spark, table).read(version)


def read_rejected(spark: SparkSession, table: str) -> DataFrame:
    """``relativa, rechazo``: the files that the last look set aside, and why."""
    return _manifest(spark, table).where(F.col("rechazo").isNotNull()).select("relativa", "rechazo")
