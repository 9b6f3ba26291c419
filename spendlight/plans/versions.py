"""Versions of date-partitioned tables that share the folders of the days they have in common.

A version's manifest names the folder of every day of every such table. A run
over some days writes these days alone and points at the older folders for the
others, so its cost follows the days it reads and not the history.
"""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlight.sources import catalog, files

MANIFEST = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("folder", T.StringType()),
        T.StructField("made_at", T.TimestampType()),
        T.StructField("version", T.StringType()),
    ]
)


def _manifests(output: str) -> str:
    return f"{output.rstrip('/')}/_manifests"


def day_folders(spark: SparkSession, table: str, path: str, schema: T.StructType) -> DataFrame:
    """table, date, folder of the days written at ``path``; only folder names are read."""
    days = files.read_parquet(spark, path, schema).select("date").where("date is not null").distinct()
    return days.select(F.lit(table).alias("table"), "date", F.concat(F.lit(f"{path}/date="), "date").alias("folder"))


def write_manifest(days: DataFrame, output: str, version: str) -> None:
    """Record the day folders (table, date, folder) of a version, in one small file."""
    stamped = days.select("table", "date", "folder", F.current_timestamp().alias("made_at"))
    # One row per table and day.
    files.write_parquet(stamped.coalesce(1), f"{_manifests(output)}/version={version}")


def read_manifests(spark: SparkSession, output: str) -> DataFrame:
    return files.read_parquet(spark, _manifests(output), MANIFEST)


def manifest(spark: SparkSession, output: str, version: str) -> DataFrame:
    """table, date, folder of a version."""
    return read_manifests(spark, output).where(F.col("version") == version).select("table", "date", "folder")


def merged_days(old: DataFrame | None, new: DataFrame, first: Date | str | None, last: Date | str | None) -> DataFrame:
    """The days of the new folders, and the old ones outside ``first`` to ``last``.

    Without bounds the new folders are all there is. A day inside them that no
    longer has rows is gone.
    """
    if old is None or first is None:
        return new
    outside = ~F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return old.where(outside).unionByName(new)


def register(
    spark: SparkSession, database: str, table: str, version: str, output: str, schema: T.StructType, location: str
) -> None:
    """Register a version of a table whose days may lie in folders of several versions."""
    rows = manifest(spark, output, version).where(F.col("table") == table).orderBy("date").collect()
    days = [(r.date.isoformat(), r.folder) for r in rows]
    catalog.register_days(spark, database, catalog.versioned(table, version), location, schema, "date", days)


def expire(spark: SparkSession, database: str, output: str, keep: int = 2) -> list[str]:
    """Drop all versions but the newest ``keep`` and the files that none of these points at; gives what was dropped.

    The published version always stays. Day folders of a dropped version live on
    while a kept manifest names them.
    """
    base = output.rstrip("/")
    made = read_manifests(spark, base).groupBy("version").agg(F.max("made_at").alias("made_at"))
    versions = [r.version for r in made.orderBy(F.desc("made_at"), F.desc("version")).collect()]
    kept = {*versions[:keep], catalog.published_version(spark, database, "fact_campaign_daily")}
    dropped = [v for v in versions if v not in kept]
    # A row per day folder.
    needed = {r.folder for r in read_manifests(spark, base).where(F.col("version").isin(*kept)).collect()}
    for version in dropped:
        for t in spark.catalog.listTables(database, f"*__{version}"):
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{t.name}`")
        for path in files.children(spark, f"{base}/{version}"):
            _delete_unneeded(spark, path, needed)
    for version in dropped:
        files.delete(spark, f"{_manifests(base)}/version={version}")
    return dropped


def _delete_unneeded(spark: SparkSession, path: str, needed: set[str]) -> None:
    if not any(folder.startswith(f"{path}/") for folder in needed):
        if path not in needed:
            files.delete(spark, path)
        return
    for child in files.children(spark, path):
        _delete_unneeded(spark, child, needed)
