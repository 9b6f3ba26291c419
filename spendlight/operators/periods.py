"""Rollups by week, month over month, place and device."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlight.functions import with_metrics
from spendlight.operators.marts import MEASURES, measure_sums
from spendlight.operators.star import sales, traffic


def weekly_summary(fact: DataFrame) -> DataFrame:
    """Measures and ratios per ISO week (by its Monday) and channel.

    Grouping by the Monday keeps the week that spans New Year in one piece.
    """
    monday = F.expr("cast(date_trunc('week', date) as date) as week_start")
    per_week = fact.groupBy(monday, "channel").agg(*measure_sums())
    return with_metrics(per_week).orderBy("week_start", "channel")


def with_prior_month(monthly: DataFrame) -> DataFrame:
    """Monthly ROAS per channel next to the calendar month before; NULL where the channel has no such month.

    A window holds one row per month of one channel.
    """
    over = "over (partition by channel order by year, month)"
    adjacent = f"lag(year * 12 + month) {over} = year * 12 + month - 1"
    return (
        monthly.select("year", "month", "channel", "spend_usd", "revenue_usd", "roas")
        .withColumn("prior_roas", F.expr(f"if({adjacent}, lag(roas) {over}, null)"))
        .withColumn("roas_change", F.expr("cast(round(cast(roas - prior_roas as decimal(38,10)), 2) as double)"))
    )


def roas_by_geo(
    ad_events: DataFrame, conversions: DataFrame, users: DataFrame, place: str = "country_code"
) -> DataFrame:
    """Spend, revenue and ROAS by the user's place; unknown users count as NULL.

    Both streams are rolled up by user before they meet the user table, so a
    user with very many events is two rows there.
    """
    per_user = (
        ad_events.groupBy("user_id")
        .agg(*traffic())
        .unionByName(conversions.groupBy("user_id").agg(*sales()), allowMissingColumns=True)
    )
    per_geo = (
        per_user.join(users.select("user_id", F.col(place).alias("geo")), "user_id", "left")
        .groupBy("geo")
        .agg(*[F.expr(f"coalesce(sum({m}), 0) as {m}") for m in MEASURES])
    )
    return with_metrics(per_geo)


def traffic_by_geo(ad_events: DataFrame) -> DataFrame:
    """Spend and click-through rate by the place that the ad events themselves name."""
    return with_metrics(ad_events.groupBy("geo").agg(*traffic()), ["ctr_pct"])


def traffic_by_device(ad_events: DataFrame) -> DataFrame:
    """Spend and click-through rate by device (conversions carry no device)."""
    return with_metrics(ad_events.groupBy("device").agg(*traffic()), ["ctr_pct"])
