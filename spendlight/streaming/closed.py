"""Days closed by event time: each is emitted once, when the watermark has passed it; and alerts on what is closed.

The delta form in ``daily`` never loses a row and changes a day for ever. Here
a day stays as it was emitted: rows that come after its close are left out, and
``late_cells`` shows them, as the difference to the deltas.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from spendlight.functions import MONEY_TYPE, units_sum
from spendlight.operators.star import APART
from spendlight.streaming import daily

#: How much later than the newest day another day's rows may come.
DELAY = "1 day"
UNITS = 100_000_000


def closed_days(contributed: DataFrame, delay: str = DELAY) -> DataFrame:
    """Cells of the days that end ``delay`` or more before the newest day, for a stream of contributions.

    One row per campaign and day, in append mode. State holds the open days
    alone. Rows without a date belong to no day; those without a campaign stay
    apart, as in ``star.daily_cells``.
    """
    timed = contributed.withColumn("day", F.col("date").cast("timestamp")).withWatermark("day", delay)
    counted = ("ad_rows", "impressions", "clicks", "orders", "new_customers")
    sums = [F.sum(c).alias(c) for c in counted]
    money = [units_sum(f"{m}_units").alias(f"{m}_usd") for m in ("spend", "revenue")]
    cells = timed.groupBy(F.window("day", "1 day"), "campaign_id", F.expr(f"{APART} as apart")).agg(*sums, *money)
    # Rows that add nothing move the watermark, but make no cell.
    cells = cells.where("ad_rows + orders > 0").withColumn("date", F.col("window.start").cast("date"))
    return cells.select(daily.CELLS.fieldNames())


def start(contributed: DataFrame, folder: str, delay: str = DELAY, *, trigger: dict | None = None) -> StreamingQuery:
    """Start the stream that appends closed days to ``folder``/closed; a restart goes on where it stopped."""
    contributed.sparkSession.createDataFrame([], daily.CELLS).write.mode("append").parquet(f"{folder}/closed")
    return (
        closed_days(contributed, delay)
        .writeStream.outputMode("append")
        .option("checkpointLocation", f"{folder}/closed-checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .format("parquet")
        .start(f"{folder}/closed")
    )


def read_closed(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(daily.CELLS).parquet(f"{folder}/closed")


def late_cells(closed: DataFrame, every: DataFrame) -> DataFrame:
    """What came after the close: measures per campaign and closed day that are in ``every`` cell but not in ``closed``.

    A day is closed if it is not after the last closed one. Both sides are
    summed by campaign and day with opposite signs, in exact units.
    """
    last = closed.agg(F.max("date").alias("last"))
    names = daily.CELLS.fieldNames()
    sign = lambda df, s: df.select(
        "campaign_id", "date", F.expr(f"{APART} as apart"), *[(F.col(n) * s).alias(n) for n in names[2:]]
    )
    both = sign(every.where(F.col("date") <= last.scalar()), 1).unionByName(sign(closed, -1))
    types = {f.name: f.dataType for f in daily.CELLS}
    sums = [F.sum(n).cast(types[n]).alias(n) for n in names[2:]]
    late = both.groupBy("campaign_id", "date", "apart").agg(*sums).where("ad_rows + orders <> 0")
    return late.select(names)


# --- alerts -------------------------------------------------------------------

ALERTS = "campaign_id string, date date, spend_units long, revenue_units long"
STATE = "spend long, revenue long, below boolean"


def _crossings(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    spend, revenue, below = state.get if state.exists else (0, 0, False)
    out = []
    # The newly closed days of one campaign.
    for day in pd.concat(list(frames)).sort_values("date").itertuples():
        spend, revenue = spend + int(day.spend_units), revenue + int(day.revenue_units)
        was, below = below, spend > 0 and revenue < spend
        if below and not was:
            out.append((key[0], day.date, spend, revenue))
    state.update((spend, revenue, below))
    if out:
        yield pd.DataFrame(out, columns=["campaign_id", "date", "spend_units", "revenue_units"])


def roas_crossings(closed: DataFrame) -> DataFrame:
    """Alerts of a stream of closed days: where a campaign's ROAS so far falls below 1.0.

    One alert at each crossing and none while it stays below. State is three
    values per campaign; a campaign's days come in order, batch by batch.
    """
    wanted = closed.where("campaign_id is not null").select(
        "campaign_id",
        "date",
        F.expr(f"cast(spend_usd * {UNITS} as bigint) as spend_units"),
        F.expr(f"cast(revenue_usd * {UNITS} as bigint) as revenue_units"),
    )
    return wanted.groupBy("campaign_id").applyInPandasWithState(_crossings, ALERTS, STATE, "append", "NoTimeout")


def start_alerts(spark: SparkSession, folder: str, *, trigger: dict | None = None) -> StreamingQuery:
    """Start the stream from ``folder``/closed to ``folder``/alerts."""
    spark.createDataFrame([], ALERTS).write.mode("append").parquet(f"{folder}/alerts")
    closed = spark.readStream.schema(daily.CELLS).parquet(f"{folder}/closed")
    return (
        roas_crossings(closed)
        .writeStream.outputMode("append")
        .option("checkpointLocation", f"{folder}/alerts-checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .format("parquet")
        .start(f"{folder}/alerts")
    )


def read_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """campaign_id, date, spend_usd, revenue_usd: the sums up to each crossing."""
    found = spark.read.schema(ALERTS).parquet(f"{folder}/alerts")
    dollars = [f"cast(cast({c}_units as decimal(20,0)) / {UNITS} as {MONEY_TYPE}) as {c}_usd" for c in ("spend", "revenue")]
    return found.selectExpr("campaign_id", "date", *dollars)
