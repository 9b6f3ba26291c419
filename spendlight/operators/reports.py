"""Datasets behind the dashboard: totals, shares, funnel, trends and rankings."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendlight.functions import (
    METRICS, channel_color, money_sum, ratio, roas_band, roas_color, roas_direction, roas_status, roas_verdict,
    with_metrics,
)
from spendlight.functions.labels import ROAS_AXIS, ROAS_BENCHMARK
from spendlight.operators.marts import TOTALS, measure_sums


# --- totals -----------------------------------------------------------------


def _plain_ratio(top: str, bottom: str, factor: int = 1) -> Column:
    """Unrounded quotient of two totals, 0 where the denominator is not positive."""
    return F.expr(f"if({bottom} > 0, cast({top} as double) / cast({bottom} as double), 0.0D) * {factor}")


def overall_kpis(channels: DataFrame) -> DataFrame:
    """One row: totals over the channel mart and their unrounded ratios."""
    totals = channels.selectExpr(*[f"coalesce(sum({name}), 0) as {name}" for name in TOTALS.values()])
    return totals.withColumns(
        {
            metric: _plain_ratio(f"total_{top}", f"total_{bottom}", factor)
            for metric, (top, bottom, factor) in METRICS.items()
        }
    )


# Funnel stages in order, with the measure behind each.
FUNNEL = [
    ("Impressions", "total_impressions"),
    ("Clicks", "total_clicks"),
    ("Orders", "total_orders"),
    ("New Customers", "total_new_customers"),
]


def conversion_funnel(kpis: DataFrame) -> DataFrame:
    """Four rows: each stage and its percentage of the impressions."""
    rows = ", ".join(f"{step}, '{stage}', cast({name} as bigint)" for step, (stage, name) in enumerate(FUNNEL, 1))
    stages = kpis.selectExpr("total_impressions", f"stack({len(FUNNEL)}, {rows}) as (step, stage, value)")
    share = ratio("value", "total_impressions", factor=100, on_zero="zero")
    return stages.select("step", "stage", "value", share.alias("pct_of_impressions"))


def roas_gauge(kpis: DataFrame, benchmark: float = ROAS_BENCHMARK) -> DataFrame:
    """Overall ROAS against the benchmark, with its band and axis position."""
    low, high = ROAS_AXIS
    return kpis.select(
        "roas",
        F.expr(f"{benchmark}D as benchmark"),
        F.expr(f"roas - {benchmark}D as delta"),
        roas_band("roas").alias("band"),
        F.expr(f"greatest({low}D, least({high}D, roas)) as axis_value"),
        roas_color("roas").alias("color"),
    )


# --- channels ---------------------------------------------------------------


def share_of_total(channels: DataFrame, measure: str, share: str) -> DataFrame:
    """Each channel's percentage of a measure's total, rounded one by one."""
    total = channels.agg(F.sum(measure)).scalar()
    return (
        channels.select("channel", measure)
        .withColumn("_total", total)
        .select("channel", measure, ratio(measure, "_total", factor=100).alias(share))
    )


def channel_cards(channels: DataFrame) -> DataFrame:
    """The channel mart with missing ratios shown as 0, status, verdict and color."""
    ratios = ["roas", "cac", "conv_rate_pct", "ctr_pct"]
    filled = channels.withColumns({name: F.expr(f"coalesce({name}, 0.0D)") for name in ratios})
    return filled.select(
        "channel", "campaign_count", "total_spend_usd", "total_revenue_usd", *ratios,
        roas_status("roas").alias("status"),
        roas_verdict("roas").alias("verdict"),
        channel_color("channel").alias("channel_color"),
    )


def channel_roas(channels: DataFrame) -> DataFrame:
    return channels.select("channel", "roas")


def channel_ranked(channels: DataFrame) -> DataFrame:
    """Channels by ROAS, best first."""
    return channels.select("channel", "campaign_count", "total_spend_usd", "total_revenue_usd", "roas").orderBy(
        F.desc_nulls_last("roas"), "channel"
    )


def roas_statuses(df: DataFrame, *labels: str) -> DataFrame:
    """Status, direction, color and verdict of each row's ROAS."""
    return df.select(
        *labels,
        "roas",
        roas_status("roas").alias("status"),
        roas_direction("roas").alias("direction"),
        roas_color("roas").alias("color"),
        roas_verdict("roas").alias("verdict"),
    )


# --- days -------------------------------------------------------------------


def daily_trend(daily: DataFrame) -> DataFrame:
    """Spend, revenue and the mean of the rows' ROAS per day.

    The mean is over rows that have a ROAS. It adds up the rounded values
    exactly, so it does not depend on row order.
    """
    return (
        daily.groupBy("date")
        .agg(
            F.sum("spend_usd").alias("spend"),
            F.sum("revenue_usd").alias("revenue"),
            money_sum("roas").alias("_roas"),
            F.count("roas").alias("_rows"),
        )
        .select("date", "spend", "revenue", ratio("_roas", "_rows", digits=6).alias("roas"))
        .orderBy("date")
    )


def channel_daily_share(daily: DataFrame) -> DataFrame:
    """Spend per day and channel and its percentage of the day's spend."""
    per_channel = daily.groupBy("date", "channel").agg(F.expr("sum(spend_usd) as spend_usd"))
    of_day = F.expr("sum(spend_usd) over (partition by date)")
    return per_channel.withColumn("_day", of_day).select(
        "date", "channel", "spend_usd", ratio("spend_usd", "_day", factor=100).alias("share_pct")
    )


def channel_daily_trend(daily: DataFrame) -> DataFrame:
    """Measures and ratios per day and channel."""
    return with_metrics(daily.groupBy("date", "channel").agg(*measure_sums())).orderBy("date", "channel")


# --- campaigns --------------------------------------------------------------


def campaign_options(campaigns: DataFrame) -> DataFrame:
    """Selector entries, ``name (channel)``, and the key they stand for."""
    return campaigns.selectExpr("concat(campaign_name, ' (', channel, ')') as label", "campaign_key")


def campaign_lookup(campaigns: DataFrame, campaign_key: int) -> DataFrame:
    """The headline figures of one campaign."""
    return (
        campaigns.where(F.col("campaign_key") == campaign_key)
        .limit(1)
        .select("campaign_key", "campaign_name", "total_spend_usd", "total_revenue_usd", "roas", "cac")
    )


def campaign_daily_series(daily: DataFrame, campaign_key: int) -> DataFrame:
    """Spend, revenue and ROAS of one campaign day by day."""
    return (
        daily.where(F.col("campaign_key") == campaign_key)
        .select("campaign_key", "date", "spend_usd", "revenue_usd", "roas")
        .orderBy("date")
    )


def ranked_by_roas(campaigns: DataFrame, k: int, best: bool = True) -> DataFrame:
    """The k best or worst campaigns; ties go by key, an unknown ROAS comes last.

    The rank is numbered over the k rows the top-k step leaves.
    """
    by_roas = F.desc_nulls_last("roas") if best else F.asc_nulls_last("roas")
    kept = campaigns.orderBy(by_roas, "campaign_key").limit(k)
    return kept.select(
        F.row_number().over(W.orderBy(by_roas, "campaign_key")).alias("rank"),
        "campaign_key", "campaign_name", "channel", "campaign_type", "roas", "total_spend_usd", "total_revenue_usd",
    )


def _day_of(key: int, month: int, day: int) -> Column:
    """The day of a date key; the given day of its year for one that is no day."""
    try:
        found = Date(key // 10_000, key // 100 % 100, key % 100)
    except ValueError:
        found = Date(min(max(key // 10_000, 1), 9999), month, day)
    return F.lit(found.isoformat()).cast("date")


def roas_filtered(
    fact: DataFrame, dim_campaign: DataFrame, channel: str, campaign_type: str, first_key: int, last_key: int
) -> DataFrame:
    """ROAS of one channel and campaign type between two date keys.

    The keys are also a range of dates, so a fact stored by date reads these folders alone.
    """
    chosen = dim_campaign.where((F.col("channel") == channel) & (F.col("campaign_type") == campaign_type)).select(
        "campaign_key"
    )
    totals = (
        fact.where(F.col("date_key").between(first_key, last_key))
        .where(F.col("date").between(_day_of(first_key, 1, 1), _day_of(last_key, 12, 31)))
        .select("campaign_key", "spend_usd", "revenue_usd")
        .join(chosen, "campaign_key")
        .agg(F.sum("spend_usd").alias("spend_usd"), F.sum("revenue_usd").alias("revenue_usd"))
    )
    return with_metrics(totals, ["roas"])


def roas_alerts(campaigns: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Campaigns whose ROAS is below the threshold."""
    return campaigns.where(F.col("roas") < threshold).select(
        "campaign_key", "campaign_name", "channel", "roas", "total_spend_usd", "total_revenue_usd"
    )
