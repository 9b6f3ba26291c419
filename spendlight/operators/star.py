"""The star schema: two dimensions and the campaign-by-day fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlight.functions import (
    MONEY_TYPE, calendar_columns, date_key, money_sum, money_units, units_sum, with_metrics,
)
from spendlight.operators.keys import with_stable_key
from spendlight.schemas import DIM_CAMPAIGN, DIM_DATE, FACT


def days_between(span: DataFrame) -> DataFrame:
    """One row per day of a one-row table (first_day, last_day)."""
    return span.select(F.explode(F.sequence("first_day", "last_day")).alias("date_id"))


def date_dimension(days: DataFrame) -> DataFrame:
    """Calendar attributes and the integer key for each ``date_id``."""
    return days.select(
        date_key("date_id").alias("date_key"),
        "date_id",
        *[column.alias(name) for name, column in calendar_columns("date_id").items()],
    ).select(DIM_DATE.fieldNames())


def campaign_dimension(campaigns: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Campaign attributes with a dense key in the order of ``campaign_id``, after those in ``known``."""
    return with_stable_key(campaigns, "campaign_key", "campaign_id", known).select(DIM_CAMPAIGN.fieldNames())


def campaign_keys(dim_campaign: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """campaign_id, campaign_key of all campaigns there ever were."""
    own = dim_campaign.select("campaign_id", "campaign_key")
    if known is None:
        return own
    return known.select(own.columns).unionByName(own.join(known, "campaign_id", "left_anti"))


def traffic() -> list[Column]:
    """Spend, impressions and clicks of a group of ad events."""
    return [
        money_sum("cost_usd").alias("spend_usd"),
        F.expr("count_if(event_type = 'impression') as impressions"),
        F.expr("count_if(event_type = 'click') as clicks"),
    ]


def sales() -> list[Column]:
    """Orders, revenue and new customers of a group of conversions."""
    return [
        F.expr("count(*) as orders"),
        money_sum("conversion_value_usd").alias("revenue_usd"),
        F.expr("sum(is_new_customer) as new_customers"),
    ]


def event_rollup(ad_events: DataFrame) -> DataFrame:
    """Spend, impressions and clicks per campaign and day."""
    return ad_events.groupBy("campaign_id", "event_date").agg(*traffic())


def conversion_rollup(conversions: DataFrame) -> DataFrame:
    """Orders, revenue and new customers per campaign and day."""
    return conversions.groupBy("campaign_id", "conversion_date").agg(*sales())


MEASURES = ["spend_usd", "impressions", "clicks", "orders", "revenue_usd", "new_customers"]


def contributions(ad_events: DataFrame, conversions: DataFrame) -> DataFrame:
    """Both tables as one, each row with what it adds to every measure of its campaign and day."""
    spent = ad_events.selectExpr(
        "campaign_id",
        "event_date as date",
        "1L as ad_rows",
        f"{money_units('cost_usd')} as spend_units",
        "if(event_type = 'impression', 1L, 0L) as impressions",
        "if(event_type = 'click', 1L, 0L) as clicks",
        "0L as orders",
        "0L as revenue_units",
        "0L as new_customers",
    )
    earned = conversions.selectExpr(
        "campaign_id",
        "conversion_date as date",
        "0L as ad_rows",
        "0L as spend_units",
        "0L as impressions",
        "0L as clicks",
        "1L as orders",
        f"{money_units('conversion_value_usd')} as revenue_units",
        "cast(is_new_customer as bigint) as new_customers",
    )
    return spent.unionByName(earned)


# Unknown campaigns and days are not equal to each other, as in a join.
APART = "if(campaign_id is null or date is null, ad_rows > 0, null)"


def daily_cells(contributed: DataFrame, *more: str) -> DataFrame:
    """Measures per campaign and day, and the number of ad events (``ad_rows``) behind them.

    One grouping with a map-side step, so a campaign that owns a large share of
    the events is only as many rows as it has days. ``more`` are attributes of
    the campaign to keep. Rows without a campaign or day meet nothing: ad events
    and conversions among them stay in cells of their own.
    """
    counted = ("ad_rows", "impressions", "clicks", "orders", "new_customers")
    counts = [F.expr(f"coalesce(sum({c}), 0) as {c}") for c in counted]
    money = [
        F.coalesce(units_sum(f"{m}_units"), F.lit(0).cast(MONEY_TYPE)).alias(f"{m}_usd") for m in ("spend", "revenue")
    ]
    cells = contributed.groupBy("campaign_id", "date", *more, F.expr(f"{APART} as apart"))
    return cells.agg(*counts, *money).drop("apart")


def fact_of_cells(cells: DataFrame, dim_campaign: DataFrame, *, on_zero: str = "null") -> DataFrame:
    """One row per campaign and day that had ad events.

    Conversions of a campaign and day without ad events are not part of the
    fact; ``quality.dropped_cells`` reports them.
    """
    labels = dim_campaign.select("campaign_id", "campaign_key", "channel", "campaign_type")
    labelled = (
        cells.where("ad_rows > 0")
        .select("campaign_id", "date", *MEASURES)
        .join(labels, "campaign_id", "left")
        .withColumn("date_key", date_key("date"))
    )
    return with_metrics(labelled, on_zero=on_zero).select(FACT.fieldNames())


def campaign_daily_fact(
    ad_events: DataFrame, conversions: DataFrame, dim_campaign: DataFrame, *, on_zero: str = "null"
) -> DataFrame:
    """The fact, straight from the raw tables."""
    return fact_of_cells(daily_cells(contributions(ad_events, conversions)), dim_campaign, on_zero=on_zero)
