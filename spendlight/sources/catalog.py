"""Databases and external tables in whatever catalog the session uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def register_parquet(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    schema: T.StructType,
    partition_by: str | None = None,
    replace: bool = False,
) -> None:
    """Register the Parquet folder at ``location`` as an external table.

    An existing table is kept, unless ``replace`` is set; dropping an external
    table leaves its files alone. Partitions follow the folders found there.
    """
    name = f"`{database}`.`{table}`"
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    fields = [f for f in schema if f.name != partition_by]
    if partition_by:
        fields.append(schema[partition_by])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    partitioning = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitioning} LOCATION '{location}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def register_days(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    schema: T.StructType,
    partition_by: str,
    folders: list[tuple[str, str]],
) -> None:
    """Register a partitioned external table whose partitions lie in the given folders: (value, folder).

    Nothing is listed but what a query reads: partitions are known by name.
    """
    name = f"`{database}`.`{table}`"
    fields = [f for f in schema if f.name != partition_by] + [schema[partition_by]]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`{partition_by}`)"
        f" LOCATION '{location}'"
    )
    for i in range(0, len(folders), 500):
        parts = " ".join(f"PARTITION (`{partition_by}` = '{v}') LOCATION '{place}'" for v, place in folders[i : i + 500])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def publish(spark: SparkSession, database: str, table: str, version: str) -> None:
    """Let the view ``table`` show the version registered as ``table__version``.

    The switch is one statement of the catalog: readers see the old rows or the
    new ones, and a query that has begun goes on over the old files.
    """
    source = f"`{database}`.`{versioned(table, version)}`"
    spark.sql(
        f"CREATE OR REPLACE VIEW `{database}`.`{table}` TBLPROPERTIES ('version' = '{version}')"
        f" AS SELECT * FROM {source}"
    )


def published_version(spark: SparkSession, database: str, table: str) -> str | None:
    """The version that a published view shows; None where there is no such view."""
    if not spark.catalog.tableExists(f"`{database}`.`{table}`"):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{table}`").where("key = 'version'").first()
    return found.value if found else None


def versioned(table: str, version: str) -> str:
    return f"{table}__{version}"


def load_tables(spark: SparkSession, database: str, pattern: str = "mart_*") -> dict[str, DataFrame]:
    """Published tables whose name matches ``pattern``, by name; versions of them are left out."""
    names = sorted(t.name for t in spark.catalog.listTables(database, pattern) if "__" not in t.name)
    return {name: spark.table(f"`{database}`.`{name}`") for name in names}
