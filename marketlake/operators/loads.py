"""Table creation and the write modes of the lake.

Rows are always matched to a table by column name, never by position.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from marketlake import files, schemas
from marketlake.operators.buckets import BucketedTable
from marketlake.operators.snapshots import Snapshots


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partitioned_by: tuple[str, ...] = (),
    location: str | None = None,
) -> str:
    """Create a parquet table if it is missing. With a location it is external, and an
    application with a fresh catalog takes up the rows that are there. A table of that name
    somewhere else is refused: its rows are not ours to read or replace."""
    if spark.catalog.tableExists(name):
        if location and not files.same_place(spark, _location(spark, name), location):
            raise ValueError(f"table {name} lies in {_location(spark, name)}, not in {location}")
        return name
    layout = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    place = f" LOCATION '{location}'" if location else ""
    columns = schemas.columns_ddl(schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}{place}")
    if partitioned_by and location and files.exists(spark, location):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"]


LAYERS = tuple(dict.fromkeys(name.split(".")[0] for name in schemas.TABLES))


class Lake:
    """The three layers under ``root``. Their databases are called raw, stg and marts where the
    catalog has none of these names, or has them in this root; a further lake of the catalog gets
    a prefix that follows from its root, so no lake sees the tables of another. With an explicit
    ``prefix``, databases of these names in another place are refused."""

    def __init__(self, spark: SparkSession, root: str, prefix: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        own = f"lake_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}_"
        if prefix is None:
            prefix = "" if self._free("") and not self._taken(own) else own
        if not self._free(prefix):
            raise ValueError(f"databases {prefix}{LAYERS[0]} and others belong to another lake than {self.root}")
        self.prefix = prefix

    def _taken(self, prefix: str) -> bool:
        return any(self.spark.catalog.databaseExists(prefix + layer) for layer in LAYERS)

    def _free(self, prefix: str) -> bool:
        """Whether all databases under a prefix are missing or lie in this root."""
        catalog = self.spark.catalog
        return all(
            files.same_place(self.spark, catalog.getDatabase(prefix + layer).locationUri, f"{self.root}/{layer}")
            for layer in LAYERS
            if catalog.databaseExists(prefix + layer)
        )

    def create(self) -> Lake:
        """Create every layer and table that is not there yet."""
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} LOCATION '{self.root}/{layer}'"
            )
        for name, (schema, partitioned_by) in schemas.TABLES.items():
            location = f"{self.root}/{name.replace('.', '/')}"
            create_table(self.spark, self.name(name), schema, partitioned_by, location)
        for name, schema in schemas.MARTS.items():
            self._no_table(name)
            if not self.mart(name).show_newest():
                self._show_nothing(name, schema)
        for name, (of, schema) in schemas.PROJECTIONS.items():
            self._no_table(name)
            columns = ", ".join(schema.fieldNames())
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(name)} AS SELECT {columns} FROM {self.name(of)}")
        for name in schemas.LIVE_TABLES:
            if not self.spark.catalog.tableExists(self.name(name)):
                self._show_last_session(name)
        return self

    def _no_table(self, name: str) -> None:
        """A table of an earlier layout leaves its name to a view; its files stay."""
        catalog = self.spark.catalog
        if catalog.tableExists(self.name(name)) and catalog.getTable(self.name(name)).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {self.name(name)}")

    def _show_nothing(self, name: str, schema: T.StructType) -> None:
        columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(name)} AS SELECT {columns} WHERE false")

    def mart(self, name: str) -> Snapshots:
        """The versions of a mart; its view has the mart's name."""
        return Snapshots(self.spark, f"{self.root}/versions/{name}", schemas.MARTS[name], view=self.name(name))

    def _show_last_session(self, table: str) -> None:
        """The view of a live table: its newest session's rows, before the first one no rows."""
        sessions = files.names_in(self.spark, f"{self.root}/live/{table}")
        days = sorted(n.removeprefix("session=") for n in sessions if n.startswith("session="))
        if not any(self.live(table, day).show_newest() for day in reversed(days)):
            self._show_nothing(table, schemas.LIVE_TABLES[table])

    def live(self, table: str, ds: str) -> BucketedTable:
        """One session's versions of a live table; its view has the table's name."""
        path = f"{self.root}/live/{table}/session={ds}"
        return BucketedTable(self.spark, path, schemas.LIVE_TABLES[table], view=self.name(table))

    def name(self, table: str) -> str:
        return self.prefix + table

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))


_MODE = "spark.sql.sources.partitionOverwriteMode"


def _insert(df: DataFrame, table: str, by: tuple[str, ...], overwrite: bool, mode: str = "STATIC") -> int:
    """Insert by name and return the row count, observed during the write itself. What an
    overwrite replaces is said here, whatever the session's setting is.

    ``by`` names the table's partition columns: rows are then gathered into few files per
    partition, and adaptive execution splits partitions that are too large for a task.
    """
    written = Observation()
    rows = df.select(*df.sparkSession.table(table).columns)
    if by:
        rows = rows.hint("rebalance", *by)
    rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    conf = df.sparkSession.conf
    before = conf.get(_MODE)
    conf.set(_MODE, mode)
    try:
        rows.write.insertInto(table, overwrite=overwrite)
    finally:
        conf.set(_MODE, before)
    return written.get["rows"]


def append(df: DataFrame, table: str, by: tuple[str, ...] = ()) -> int:
    return _insert(df, table, by, overwrite=False)


def overwrite(df: DataFrame, table: str, by: tuple[str, ...] = ()) -> int:
    """Replace the whole table. The rows must not be read from the table itself."""
    return _insert(df, table, by, overwrite=True)


def overwrite_partitions(df: DataFrame, table: str, by: tuple[str, ...]) -> int:
    """Replace the partitions that the rows fall into and leave all others."""
    return _insert(df, table, by, overwrite=True, mode="DYNAMIC")


def create_as(df: DataFrame, table: str) -> None:
    """Create the table from the rows, replacing one that is there."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def replace_day(df: DataFrame, table: str, by: str, day: dt.date) -> None:
    """Delete one day's partition (column ``by``) and insert its rows, as one static
    partition overwrite.

    Repeating it gives the same table, and an empty day empties the partition, which a
    dynamic partition overwrite would leave alone.
    """
    spark = df.sparkSession
    columns = ", ".join(c for c in spark.table(table).columns if c != by)
    spark.sql(
        f"INSERT OVERWRITE {table} PARTITION ({by} = DATE '{day.isoformat()}') "
        f"SELECT {columns} FROM {{rows}} WHERE {by} = DATE '{day.isoformat()}'",
        rows=df,
    )


def target_day(ds: str | dt.date, lag_days: int = 0) -> dt.date:
    """The date a run for ``ds`` loads: ``ds`` itself or that many calendar days before."""
    day = dt.date.fromisoformat(ds) if isinstance(ds, str) else ds
    return day - dt.timedelta(days=lag_days)


def staging_to_fact(staging: DataFrame, day: dt.date | Column | None = None) -> DataFrame:
    """Staging rows under the fact's names; one date, or all when none is given."""
    rows = staging if day is None else staging.where(F.col("snapshot_date") == F.lit(day))
    return rows.select(
        "ticker",
        *(F.col(p).alias(f"{p}_price") for p in ("open", "high", "low", "close")),
        F.col("volume").cast("bigint").alias("volume"),
        F.col("snapshot_date").alias("trade_date"),
    )
