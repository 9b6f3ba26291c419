"""Rollups of the fact. Ratios are always ratios of summed measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlight.functions import with_metrics

MEASURES = ["spend_usd", "revenue_usd", "impressions", "clicks", "orders", "new_customers"]
TOTALS = {measure: f"total_{measure}" for measure in MEASURES}


def measure_sums(names: dict[str, str] | None = None) -> list[Column]:
    """Sums of the measures, under their own names or the given ones."""
    return [F.expr(f"sum({m}) as {names[m] if names else m}") for m in MEASURES]


def channel_summary(fact: DataFrame, *, on_zero: str = "null") -> DataFrame:
    """One row per channel.

    The distinct count makes Spark aggregate by channel and campaign first and
    by channel second, so a dominant channel is spread over its campaigns.
    """
    totals = fact.groupBy("channel").agg(
        F.expr("count(distinct campaign_key) as campaign_count"), *measure_sums(TOTALS)
    )
    return with_metrics(totals, names=TOTALS, on_zero=on_zero)


def campaign_summary(fact: DataFrame, dim_campaign: DataFrame, *, on_zero: str = "null") -> DataFrame:
    """One row per campaign, named after the rollup (the smaller join)."""
    totals = fact.groupBy("campaign_key", "channel", "campaign_type").agg(*measure_sums(TOTALS))
    named = totals.join(dim_campaign.select("campaign_key", "campaign_name", "status"), "campaign_key", "left")
    return with_metrics(named, ["roas", "cac", "conv_rate_pct"], names=TOTALS, on_zero=on_zero).select(
        "campaign_key", "campaign_name", "channel", "campaign_type", "status",
        *TOTALS.values(), "roas", "cac", "conv_rate_pct",
    )


def monthly_totals(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """All measures per year, month and channel.

    Days are rolled up first: what meets the calendar is one row per day and
    channel, however many campaigns there are.
    """
    per_day = fact.groupBy("date_key", "channel").agg(*measure_sums())
    months = dim_date.select("date_key", "year", "month", "month_name")
    return (
        per_day.join(months, "date_key", "left")
        .groupBy("year", "month", "month_name", "channel")
        .agg(*measure_sums())
    )


def monthly_summary(fact: DataFrame, dim_date: DataFrame, *, on_zero: str = "null") -> DataFrame:
    """One row per month and channel. Readers that need an order sort at their edge."""
    months = monthly_totals(fact, dim_date).withColumnRenamed("orders", "total_orders")
    return with_metrics(months, ["roas", "cac"], on_zero=on_zero).select(
        "year", "month", "month_name", "channel", "spend_usd", "revenue_usd",
        "total_orders", "new_customers", "roas", "cac",
    )


def campaign_daily(fact: DataFrame) -> DataFrame:
    """The fact as reports read it: without the integer date key."""
    return fact.select(
        "campaign_key", "date", "channel", "campaign_type", *MEASURES, "roas", "cac", "conv_rate_pct", "ctr_pct"
    )
