"""Fixed schemas of the raw tables and the star schema (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# Money is held to 1e-8 of a dollar, see functions/metrics.py.
MONEY = T.DecimalType(28, 8)


def _struct(spec: dict[str, T.DataType], required: set[str] | None = None) -> T.StructType:
    required = required or set()
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in spec.items()])


_STR, _INT, _LONG, _DBL, _DATE = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.DateType(),
)

# Names and types of the raw tables and, below, of the star schema.
RAW = {
    "dim_advertisers": _struct(
        {
            "advertiser_id": _STR,
            "advertiser_name": _STR,
            "industry": _STR,
            "channel": _STR,
            "account_status": _STR,
        }
    ),
    "dim_campaigns": _struct(
        {
            "campaign_id": _STR,
            "campaign_name": _STR,
            "advertiser_id": _STR,
            "channel": _STR,
            "campaign_type": _STR,
            "status": _STR,
            "start_date": _DATE,
            "end_date": _DATE,
            "daily_budget_usd": _INT,
        }
    ),
    "dim_users": _struct(
        {
            "user_id": _STR,
            "age_band": _STR,
            "gender": _STR,
            "country_code": _STR,
            "acquisition_channel": _STR,
            "lifetime_value_usd": _DBL,
        }
    ),
    "dim_time": _struct(
        {
            "date_id": _DATE,
            "year": _INT,
            "month": _INT,
            "month_name": _STR,
            "day_of_month": _INT,
            "day_of_week": _INT,
            "day_name": _STR,
            "is_weekend": _INT,
            "quarter": _INT,
            "week_of_year": _INT,
        }
    ),
    "fact_ad_events": _struct(
        {
            "event_id": _STR,
            "event_date": _DATE,
            "campaign_id": _STR,
            "channel": _STR,
            "event_type": _STR,
            "user_id": _STR,
            "device": _STR,
            "geo": _STR,
            "cost_usd": _DBL,
            "revenue_usd": _DBL,
            "is_conversion": _INT,
        }
    ),
    "fact_conversions": _struct(
        {
            "conversion_id": _STR,
            "conversion_date": _DATE,
            "campaign_id": _STR,
            "channel": _STR,
            "user_id": _STR,
            "conversion_type": _STR,
            "conversion_value_usd": _DBL,
            "is_new_customer": _INT,
        }
    ),
}

DIM_DATE = _struct(
    {
        "date_key": _INT,
        "date_id": _DATE,
        "year": _INT,
        "month": _INT,
        "quarter": _INT,
        "day_of_month": _INT,
        "day_of_week": _INT,
        "day_name": _STR,
        "is_weekend": _INT,
        "month_name": _STR,
        "week_of_year": _INT,
    },
    required={
        "date_key", "date_id", "year", "month", "quarter", "day_of_month",
        "day_of_week", "day_name", "is_weekend", "month_name",
    },
)

DIM_CAMPAIGN = _struct(
    {
        "campaign_key": _LONG,
        "campaign_id": _STR,
        "campaign_name": _STR,
        "channel": _STR,
        "campaign_type": _STR,
        "status": _STR,
        "start_date": _DATE,
        "end_date": _DATE,
        "daily_budget_usd": _INT,
    },
    required={
        "campaign_key", "campaign_id", "campaign_name", "channel",
        "campaign_type", "status", "start_date",
    },
)

FACT = _struct(
    {
        "campaign_key": _LONG,
        "date_key": _INT,
        "date": _DATE,
        "channel": _STR,
        "campaign_type": _STR,
        "spend_usd": MONEY,
        "impressions": _LONG,
        "clicks": _LONG,
        "orders": _LONG,
        "revenue_usd": MONEY,
        "new_customers": _LONG,
        "roas": _DBL,
        "cac": _DBL,
        "conv_rate_pct": _DBL,
        "ctr_pct": _DBL,
    },
    required={
        "campaign_key", "date_key", "spend_usd", "impressions", "clicks",
        "orders", "revenue_usd", "new_customers",
    },
)

STAR = {"dim_date": DIM_DATE, "dim_campaign": DIM_CAMPAIGN, "fact_campaign_daily": FACT}

# Keys and references the star schema promises; the quality checks test them.
PRIMARY_KEYS = {
    "dim_date": ["date_key"],
    "dim_campaign": ["campaign_key"],
    "fact_campaign_daily": ["campaign_key", "date_key"],
}
FOREIGN_KEYS = [
    ("fact_campaign_daily", "campaign_key", "dim_campaign"),
    ("fact_campaign_daily", "date_key", "dim_date"),
]


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]
