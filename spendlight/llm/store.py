"""Reading the given tables and cutting lineage through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendlight.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once under ``spark.checkpoint.dir`` and read back.

    Several later reads then share one evaluation, and a lost executor costs a
    read of files instead of the whole lineage.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
