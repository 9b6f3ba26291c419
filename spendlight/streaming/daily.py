"""Daily campaign measures kept up to date from a stream of events.

Each micro-batch adds up what its rows contribute to their campaigns and days
and writes that as one delta, keyed by the batch: a batch that is run again
after a failure leaves the same files. Nothing is held between batches, so a
row counts however late it comes. Readers add up the deltas; ``compact`` folds
those of finished batches into one base table, so their number stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendlight.functions import with_metrics
from spendlight.operators.star import APART, daily_cells
from spendlight.schemas import MONEY

_MEASURES = {
    "ad_rows": T.LongType(),
    "spend_usd": MONEY,
    "impressions": T.LongType(),
    "clicks": T.LongType(),
    "orders": T.LongType(),
    "revenue_usd": MONEY,
    "new_customers": T.LongType(),
}
CELLS = T.StructType(
    [
        T.StructField("campaign_id", T.StringType()),
        T.StructField("date", T.DateType()),
        *[T.StructField(n, t) for n, t in _MEASURES.items()],
    ]
)
DELTAS = T.StructType([*CELLS, T.StructField("batch_id", T.LongType())])
BASES = T.StructType([*CELLS, T.StructField("upto", T.LongType())])

# Days are UTC days.
STREAM_CONF = {"spark.sql.session.timeZone": "UTC"}


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster with streaming settings of its own."""
    session = spark.newSession()
    partitions = "spark.sql.shuffle.partitions"
    for key, value in {**STREAM_CONF, partitions: spark.conf.get(partitions)}.items():
        session.conf.set(key, value)
    return session


def _overwrite(df: DataFrame, path: str, partition: str) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(partition)
        .parquet(path)
    )


def add_delta(folder: str):
    """The ``foreachBatch`` step: the batch's own sums as its delta."""

    def step(batch: DataFrame, batch_id: int) -> None:
        cells = daily_cells(batch).select(CELLS.fieldNames())
        _overwrite(cells.withColumn("batch_id", F.lit(batch_id).cast("long")), f"{folder}/deltas", "batch_id")

    return step


def start(contributed: DataFrame, folder: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Start the stream over rows of contributions (``star.contributions``).

    ``folder`` holds its checkpoint, deltas and bases.
    """
    spark = contributed.sparkSession
    spark.createDataFrame([], DELTAS).write.mode("append").partitionBy("batch_id").parquet(f"{folder}/deltas")
    spark.createDataFrame([], BASES).write.mode("append").partitionBy("upto").parquet(f"{folder}/bases")
    return (
        contributed.writeStream.outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(add_delta(folder))
        .start()
    )


def _parts(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """The newest base with the deltas since, and the last batch in the base (-1: none)."""
    bases = spark.read.schema(BASES).parquet(f"{folder}/bases")
    upto = bases.agg(F.max("upto")).first()[0]
    upto = -1 if upto is None else upto
    deltas = spark.read.schema(DELTAS).parquet(f"{folder}/deltas").where(F.col("batch_id") > upto)
    base = bases.where(F.col("upto") == upto).select(*CELLS.fieldNames(), F.lit(upto).cast("long").alias("batch_id"))
    return base.unionByName(deltas), upto


def _summed(parts: DataFrame) -> DataFrame:
    sums = [F.sum(n).cast(t).alias(n) for n, t in _MEASURES.items()]
    return parts.groupBy("campaign_id", "date", F.expr(f"{APART} as apart")).agg(*sums).drop("apart")


def compact(spark: SparkSession, folder: str, last_batch: int) -> None:
    """Fold the deltas up to ``last_batch``, a finished one, into a new base.

    Readers go on with the old base until the new one is complete. Deltas in a
    base are no longer read and may be deleted.
    """
    parts, upto = _parts(spark, folder)
    if last_batch > upto:
        base = _summed(parts.where(F.col("batch_id") <= last_batch))
        _overwrite(base.withColumn("upto", F.lit(last_batch).cast("long")), f"{folder}/bases", "upto")


def daily_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The measures so far with ratios, for days and campaigns with ad events."""
    cells = _summed(_parts(spark, folder)[0]).where(F.col("ad_rows") > 0)
    return with_metrics(cells.drop("ad_rows"))
