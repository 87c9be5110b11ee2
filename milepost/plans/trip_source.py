"""Where trips come from.

Reports ask a source for the columns they need. :class:`FileTrips` reads monthly
files; :class:`StarTrips` derives trips from order and line-item tables and saves
monthly files from them, so every file report has files to work on.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.functions.expressions import Period, minutes_between
from milepost.functions.labels import SERVICIOS
from milepost.plans import monthly_state, tables
from milepost.plans.model import MAX_MINUTES, VIAJES, normalise_all, plausible, raw_contract, raw_contracts
from milepost.plans.monthly_state import MonthlyState
from milepost.plans.settings import Settings, Umbrales
from milepost.plans.workspace import new_folder
from milepost.sources import inventory
from milepost.sources.catalogue import FooterCatalogue
from milepost.sources.drift import read_with_contracts
from milepost.sources.zones import read_zones


class TripSource:
    """What the reports read, and the settings they run with.

    ``max_minutes`` is the duration cap of plausible trips.
    """

    max_minutes: float = MAX_MINUTES
    settings: Settings = Settings()
    spark: SparkSession

    def trips(self, *columns: str, raw: bool = False) -> DataFrame:
        """All trips: from the saved table if there is one, else, or with ``raw``, from the source itself."""
        raise NotImplementedError

    def zones(self) -> DataFrame:
        raise NotImplementedError

    def files(self) -> FileTrips:
        """The monthly files behind this source."""
        raise NotImplementedError

    def monthly_files(self) -> DataFrame:
        """One row per monthly file: ``tipo_taxi, anio, mes, archivo, partes, bytes``."""
        return self.files().monthly_files()

    def record_counts(self) -> DataFrame:
        """``relativa, registros`` of every monthly file."""
        return self.files().record_counts()

    def file_status(self) -> DataFrame:
        """``tipo_taxi, anio, mes, archivo, valido`` of every monthly file."""
        return self.files().file_status()

    def signatures(self) -> DataFrame:
        """As :meth:`file_status`, of the files that the source was given, which need not be monthly."""
        return self.file_status()

    def saved(self) -> DataFrame:
        """The saved copy of ``trips``."""
        raise NotImplementedError

    @cached_property
    def monthly_state(self) -> MonthlyState:
        """Aggregates of each file month, made once from all trips."""
        state = MonthlyState(self.spark, new_folder(self.spark, "estado"))
        state.update(self.trips(*monthly_state.COLUMNS))
        return state

    # Period of ``pickups`` where it is not the explored one.
    pickups_period: Period | None = None

    def pickups(self) -> DataFrame:
        """``tipo_taxi, pickup_datetime`` with real times of day, of the explored files."""
        year = self.settings.file_year
        trips = self.trips("anio", "tipo_taxi", "pickup_datetime")
        return (trips if year is None else trips.where(F.col("anio") == year)).drop("anio")

    def valid_pickups(self) -> DataFrame:
        """``pickup_datetime`` of plausible trips."""
        return self.valid("pickup_datetime")

    def valid(self, *columns: str) -> DataFrame:
        wanted = columns or tuple(VIAJES)
        source = self.trips(*tables.with_plausible_columns(wanted))
        return source.where(plausible(self.max_minutes)).select(*wanted)


class FileTrips(TripSource):
    """Monthly files below ``root``, and optionally a zone lookup, a saved table, and where their footers are kept."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        zones_csv: str | None = None,
        table: str | None = None,
        settings: Settings = Settings(),
        catalogue: str | None = None,
    ) -> None:
        self.spark, self.root, self.settings = spark, root, settings
        self.zones_csv, self.table, self._catalogue_path = zones_csv, table, catalogue

    @cached_property
    def catalogue(self) -> FooterCatalogue:
        return FooterCatalogue(self.spark, self.root, self._catalogue_path)

    @cached_property
    def _normalised(self) -> DataFrame:
        known = self.catalogue.files
        columns = known.select("ruta", "relativa", "error", F.inline_outer("columnas"))
        return normalise_all(read_with_contracts(self.spark, self.root, known, raw_contracts(), footers=columns))

    def trips(self, *columns: str, raw: bool = False) -> DataFrame:
        from_table = self.table is not None and not raw
        rows = tables.read_trips(self.spark, self.table) if from_table else self._normalised
        return rows.select(*(columns or tuple(VIAJES)))

    def zones(self) -> DataFrame:
        if self.zones_csv is None:
            raise ValueError("this source was given no zone lookup")
        return read_zones(self.spark, self.zones_csv)

    def files(self) -> FileTrips:
        return self

    def saved(self) -> DataFrame:
        if self.table is None:
            self.table = tables.write_trips(self.trips(raw=True), new_folder(self.spark, "viajes"))
        return tables.read_trips(self.spark, self.table)

    def record_counts(self) -> DataFrame:
        return self.catalogue.counts()

    def monthly_files(self) -> DataFrame:
        return inventory.monthly_files(self.spark, self.root)

    def file_status(self) -> DataFrame:
        return inventory.monthly_file_status(self.spark, self.root)

    def footers(self) -> DataFrame:
        return self.catalogue.footers()

    def rejected(self) -> DataFrame:
        """``ruta, relativa, error`` of the files that are set aside when trips are read."""
        return self.catalogue.rejected()


def _monthly_name() -> Column:
    """Name of a month's file."""
    return F.format_string("%s_tripdata_%04d-%02d.parquet", "tipo_taxi", "anio", "mes")


class StarTrips(TripSource):
    """Trips derived from ``lineitem``, ``orders``, ``customer``, ``supplier``.

    Lookups are left joins on unique keys, which neither drop nor repeat line items, so a
    table no wanted column comes from is not joined at all. ``table`` is a saved copy to answer from;
    ``buckets`` is a database made by :func:`milepost.plans.tables.write_buckets`, whose orders and line
    items are joined where they lie.
    """

    # Dates replace clock times in these tables: the cap is 360 days instead of 360 minutes.
    max_minutes = MAX_MINUTES * 1440.0

    # First period of each column that appears over time, and of the integer passenger count.
    FEE_SINCE_YEAR = 1998
    REQUEST_SINCE = "2001-06-01"

    FROM_ORDERS = ("pickup_datetime", "duracion_min", "payment_type", "request_source", "destino_id")

    # These tables cover 1995 to 2001, and 25 zones instead of 265. Period and years are
    # narrower, so that the filters have rows to drop, and one expected year has no file.
    SETTINGS = Settings(
        file_year=None,
        period=("1996-03-01", "2001-02-01"),
        quality_period=("1996-01-01", "2001-01-01"),
        years=(1996, 1998, 2000),
        expected_years=tuple(range(1995, 2003)),
        umbrales=Umbrales(horas=24_000, millas=40, pasajeros=6, monto=90_000),
        min_trips=10,
        ends=5,
        digits=2,
    )

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        settings: Settings = SETTINGS,
        table: str | None = None,
        buckets: str | None = None,
    ) -> None:
        self.spark, self.sf_dir, self.settings, self._copy = spark, sf_dir.rstrip("/"), settings, table
        self._buckets = buckets
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One of the given tables."""
        if name not in self._tables:
            bucketed = self._buckets is not None and name in tables.BUCKET_KEYS
            self._tables[name] = (
                self.spark.table(f"`{self._buckets}`.{name}")
                if bucketed
                else self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            )
        return self._tables[name]

    def trips(self, *columns: str, raw: bool = False) -> DataFrame:
        wanted = columns or tuple(VIAJES)
        if self._copy is not None and not raw:
            return tables.read_trips(self.spark, self._copy).select(*wanted)
        joined = self.table("lineitem")
        if any(c in self.FROM_ORDERS for c in wanted):
            orders = self.table("orders")
            if "destino_id" in wanted:
                # Joined to the smaller side first, so line items are shuffled once for both.
                customer = self.table("customer").select(
                    F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("destino_id")
                )
                orders = orders.join(customer, "o_custkey", "left")
            joined = joined.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        if "origen_id" in wanted:
            supplier = self.table("supplier").select(
                F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("origen_id")
            )
            joined = joined.join(supplier, "l_suppkey", "left")
        minutes = minutes_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("duracion_min")
        return joined.select(*[minutes if c == "duracion_min" else F.expr(self.MODEL[c]).alias(c) for c in wanted])

    # Trip columns as expressions over the joined tables.
    MODEL = {
        "anio": "year(l_shipdate)",
        "mes": "month(l_shipdate)",
        "tipo_taxi": "if(l_linestatus = 'O', 'yellow', 'green')",
        "pickup_datetime": "o_orderdate",
        "dropoff_datetime": "l_shipdate",
        "passenger_count": "CAST(l_linenumber AS BIGINT)",
        "trip_distance": "l_quantity",
        "ratecode_id": "CASE l_returnflag WHEN 'A' THEN 1L WHEN 'N' THEN 2L WHEN 'R' THEN 99L END",
        "payment_type": "CAST(substring(o_orderpriority, 1, 1) AS BIGINT) % 5",
        "fare_amount": "l_extendedprice",
        "tip_amount": "l_extendedprice * l_discount",
        "total_amount": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
        "cbd_congestion_fee": f"coalesce(if(year(l_shipdate) >= {FEE_SINCE_YEAR}, l_tax, NULL), 0D)",
        "request_source": (
            f"CASE WHEN l_shipdate < TIMESTAMP_NTZ '{REQUEST_SINCE}' THEN NULL "
            "WHEN o_orderstatus = 'F' THEN 'HV0003' WHEN o_orderstatus = 'O' THEN 'HV0005' "
            "WHEN o_orderstatus = 'P' AND substring(o_orderpriority, 1, 1) = '1' THEN 'HV9999' END"
        ),
        "origen_id": "origen_id",
        "destino_id": "destino_id",
    }

    def zones(self) -> DataFrame:
        region = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.table("nation").join(region, "n_regionkey").select(
            F.col("n_nationkey").alias("zona_id"),
            F.col("r_name").alias("barrio"),
            F.col("n_name").alias("zona"),
            F.lit(None).cast("string").alias("service_zone"),
        )

    def pickups(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_type").alias("tipo_taxi"), F.col("ts").alias("pickup_datetime")
        )

    # The events cover January 2024.
    pickups_period = ("2024-01-08", "2024-01-25")

    def valid_pickups(self) -> DataFrame:
        return self.pickups().select("pickup_datetime")

    def record_counts(self) -> DataFrame:
        """Counted from the line items, as the files that their months would make."""
        rows = self.trips("tipo_taxi", "anio", "mes", raw=True).groupBy("tipo_taxi", "anio", "mes")
        return rows.agg(F.count(F.lit(1)).alias("registros")).select(_monthly_name().alias("relativa"), "registros")

    def signatures(self) -> DataFrame:
        """Of the given tables' own files."""
        return inventory.monthly_file_status(self.spark, self.sf_dir)

    @cached_property
    def saved_path(self) -> str:
        return self._copy or tables.write_trips(self.trips(raw=True), new_folder(self.spark, "viajes"))

    def saved(self) -> DataFrame:
        """The table this source was given, else a copy that this source writes once; only this call reads it."""
        return tables.read_trips(self.spark, self.saved_path)

    @cached_property
    def _files(self) -> FileTrips:
        root = new_folder(self.spark, "mensual")
        self._write_monthly_files(root)
        return FileTrips(self.spark, root, table=self.saved_path, settings=self.settings)

    def files(self) -> FileTrips:
        return self._files

    def _write_monthly_files(self, root: str) -> None:
        """Raw-shaped monthly files with drift: names per service, columns and types per era.

        Each era reads only its own folders of the saved table, which is already clustered by
        month, so nothing is shuffled.
        """
        saved = self.saved()
        month = F.make_date("anio", "mes", F.lit(1))
        fee_since = F.make_date(F.lit(self.FEE_SINCE_YEAR), F.lit(1), F.lit(1))
        request_since = F.lit(self.REQUEST_SINCE).cast("date")
        request_year = int(self.REQUEST_SINCE[:4])
        # (rows of the era, columns not there yet, stored type of the passenger count)
        eras = (
            (F.col("anio") < self.FEE_SINCE_YEAR, ("cbd_congestion_fee", "request_source"), "double"),
            (
                (F.col("anio") >= self.FEE_SINCE_YEAR)
                & (F.col("anio") <= request_year)
                & (month >= fee_since)
                & (month < request_since),
                ("request_source",),
                "bigint",
            ),
            ((F.col("anio") >= request_year) & (month >= request_since), (), "bigint"),
        )
        renamed = {"RatecodeID": "ratecode_id", "PULocationID": "origen_id", "DOLocationID": "destino_id"}
        for service in SERVICIOS:
            contract = raw_contract(service)
            times = dict(zip(list(contract)[:2], ("pickup_datetime", "dropoff_datetime")))
            for rows, absent, passengers in eras:
                stored = {**contract, "passenger_count": passengers}
                columns = [
                    F.col({**renamed, **times}.get(name, name)).cast(kind).alias(name)
                    for name, kind in stored.items()
                    if name not in absent
                ]
                (
                    saved.where((F.col("tipo_taxi") == service) & rows)
                    .select("anio", "mes", *columns)
                    .write.mode("append")
                    .partitionBy("anio", "mes")
                    .parquet(f"{root}/tipo_taxi={service}")
                )
