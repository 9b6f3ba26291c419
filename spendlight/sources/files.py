"""CSV and Parquet in and out. Paths are any URI Spark's file systems know."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlight.schemas import RAW


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headered CSV file or folder with a fixed schema (one pass, no inference).

    The header must list the columns in schema order, and a value that does
    not parse stops the job instead of turning into NULL.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def malformed_rows(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    """How many rows of a headered CSV do not fit the schema, as one check; ``read_csv`` stops at the first."""
    broken = "_broken"
    rows = (
        spark.read.schema(T.StructType([*schema, T.StructField(broken, T.StringType())]))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", broken)
        .csv(path)
    )
    # Always true, but only known by reading all columns: a row is parsed no further than its columns are needed.
    parsed = F.pmod(F.xxhash64(*schema.fieldNames()), F.lit(2)) >= 0
    return rows.agg(
        F.lit(f"malformed:{name}").alias("check_name"),
        F.count_if(parsed).alias("n_checked"),
        F.count_if(parsed & F.col(broken).isNotNull()).alias("n_failed"),
    )


def read_raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the raw tables, ``<folder>/<table>.csv``."""
    return read_csv(spark, f"{folder.rstrip('/')}/{table}.csv", RAW[table])


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_parquet(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_by_date(
    df: DataFrame, path: str, *, whole: bool = False, sort_by: str = "channel", compression: str = "zstd"
) -> None:
    """Replace the date folders present in ``df``, or the whole table.

    The rebalance hint groups rows by date so that a date gets few files, and
    lets AQE split a date that outgrows one task and merge small ones. The sort
    inside the files lets readers skip row groups by ``sort_by``.
    """
    (
        df.hint("rebalance", "date")
        .sortWithinPartitions("date", sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("compression", compression)
        .partitionBy("date")
        .parquet(path)
    )


def children(spark: SparkSession, path: str) -> list[str]:
    """Paths right below a folder, on any file system that Spark knows; none where there is no such folder."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(f"{path.rstrip('/')}/{found.getPath().getName()}" for found in system.listStatus(place))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all below it."""
    place, system = _place(spark, path)
    system.delete(place, True)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of headered CSV parts, written in parallel."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_csv(df: DataFrame, path: str, most: int = 100_000) -> None:
    """One headered CSV part, for marts whose row count is bounded by design.

    More than ``most`` rows are refused; ``write_csv`` takes any number.
    """
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows for one CSV part; use write_csv")
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
