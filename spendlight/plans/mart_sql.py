"""The channel, campaign and monthly marts as SQL over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendlight.functions import ratio_sql

_ROAS = ratio_sql("total_revenue_usd", "total_spend_usd")
_CAC = ratio_sql("total_spend_usd", "total_new_customers")
_CVR = ratio_sql("total_orders", "total_clicks", 100)
_CTR = ratio_sql("total_clicks", "total_impressions", 100)

_SUMS = """
    sum(f.spend_usd) as total_spend_usd,
    sum(f.revenue_usd) as total_revenue_usd,
    sum(f.impressions) as total_impressions,
    sum(f.clicks) as total_clicks,
    sum(f.orders) as total_orders,
    sum(f.new_customers) as total_new_customers"""

CHANNEL = f"""
with t as (
  select f.channel, count(distinct f.campaign_key) as campaign_count, {_SUMS}
  from {{fact_campaign_daily}} f
  group by f.channel
)
select *, {_ROAS} as roas, {_CAC} as cac, {_CVR} as conv_rate_pct, {_CTR} as ctr_pct
from t
"""

CAMPAIGN = f"""
with t as (
  select f.campaign_key, {_SUMS}
  from {{fact_campaign_daily}} f
  group by f.campaign_key
)
select c.campaign_key, c.campaign_name, c.channel, c.campaign_type, c.status,
       t.* except (campaign_key), {_ROAS} as roas, {_CAC} as cac, {_CVR} as conv_rate_pct
from t join {{dim_campaign}} c on c.campaign_key = t.campaign_key
"""

MONTHLY = f"""
with daily as (
  select f.date_key, f.channel, {_SUMS}
  from {{fact_campaign_daily}} f
  group by f.date_key, f.channel
), t as (
  select d.year, d.month, d.month_name, f.channel,
         sum(f.total_spend_usd) as total_spend_usd, sum(f.total_revenue_usd) as total_revenue_usd,
         sum(f.total_orders) as total_orders, sum(f.total_new_customers) as total_new_customers
  from daily f join {{dim_date}} d on d.date_key = f.date_key
  group by d.year, d.month, d.month_name, f.channel
)
select year, month, month_name, channel, total_spend_usd as spend_usd, total_revenue_usd as revenue_usd,
       total_orders, total_new_customers as new_customers, {_ROAS} as roas, {_CAC} as cac
from t
order by year, month, channel
"""

MARTS = {
    "mart_channel_summary": CHANNEL,
    "mart_campaign_summary": CAMPAIGN,
    "mart_monthly_summary": MONTHLY,
}


def run_mart(spark: SparkSession, name: str, star: dict[str, DataFrame]) -> DataFrame:
    """Run a mart's SQL over star tables given as DataFrames."""
    return spark.sql(MARTS[name], **star)


def run_mart_on_catalog(spark: SparkSession, name: str, database: str) -> DataFrame:
    """Run a mart's SQL over the star tables registered in ``database``."""
    tables = {t: f"`{database}`.`{t}`" for t in ("fact_campaign_daily", "dim_campaign", "dim_date")}
    return spark.sql(MARTS[name].format(**tables))
