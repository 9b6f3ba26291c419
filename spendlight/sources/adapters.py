"""Two views of the test tables as advertising data.

Only this module knows the test tables. ``from_events`` reads the event log as
one month of ad traffic, ``from_lineitem`` reads order lines as several years
of it. Both give the raw tables the operators expect.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlight.functions import mask, masked_key, money_units, pick, short_id
from spendlight.operators.star import daily_cells
from spendlight.session import scratch_dir
from spendlight.sources import files

SALT = "spendlight_fixture_salt"

# Attribute lists of the advertising model.
CHANNELS = ["Meta", "Google", "TikTok", "Other"]
CAMPAIGN_TYPES = ["brand_awareness", "performance", "prospecting", "retargeting"]
STATUSES = ["active", "paused", "completed"]
DAILY_BUDGETS = [500, 1000, 2000, 3000, 1500, 2500, 800, 1200]

# Labels of the fixtures alone.
DEVICES = ["phone", "laptop", "pad"]
AGE_BANDS = ["to 24", "25-39", "40-59", "60 on"]
GENDERS = ["f", "m", "x"]


# Schemas of the test tables, given so that no job has to look them up.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class RawTables:
    """Campaigns, ad events, conversions, the span of days and the daily cells, built on first use.

    ``span`` has one row: first_day, last_day.
    """

    def __init__(self, folder: str, **build: Callable[[], DataFrame]):
        self.folder, self._build = folder, build

    @cached_property
    def campaigns(self) -> DataFrame:
        return self._build["campaigns"]()

    @cached_property
    def ad_events(self) -> DataFrame:
        return self._build["ad_events"]()

    @cached_property
    def conversions(self) -> DataFrame:
        return self._build["conversions"]()

    @cached_property
    def span(self) -> DataFrame:
        return self._build["span"]()

    @cached_property
    def cells(self) -> DataFrame:
        return self._build["cells"]()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _with_span(campaigns: DataFrame, span: DataFrame) -> DataFrame:
    return campaigns.withColumns(
        {"start_date": span.select("first_day").scalar(), "end_date": span.select("last_day").scalar()}
    )


# --- the event log as one month of ad traffic --------------------------------

# Events name one of 100 campaigns by a slot, "k" in the flat JSON object props:
# four channels, 25 campaigns each. A pattern reads it about five times faster
# than a JSON parser.
_SLOT = """try_cast(regexp_extract(props, '"k" *: *([0-9]+)', 1) as int)"""
_CHANNEL = pick(CHANNELS, "slot")
_PREFIX = pick([c[:2].upper() for c in CHANNELS], "slot")
_NUMBER = "cast(slot div 4 + 1 as string)"
# Padded to three digits; longer numbers stay whole (lpad alone would cut them).
_CAMPAIGN_ID = f"concat('camp_', {_PREFIX}, '_', lpad({_NUMBER}, greatest(3, length({_NUMBER})), '0')) as campaign_id"


# Test values have whole cents; this is the double nearest to a hundredth of them.
_EVENT_COST = "if(event_type = 'view', rint(value * 100) / 10000, value)"


def ad_events_of(events: DataFrame) -> DataFrame:
    """Views and clicks as ad events. A view costs one hundredth of its value."""
    return (
        events.where("event_type in ('view', 'click')")
        .selectExpr("*", f"{_SLOT} as slot")
        .select(
            short_id("event_id", SALT, "ev_").alias("event_id"),
            F.expr("cast(ts as date) as event_date"),
            F.expr(_CAMPAIGN_ID),
            F.expr(f"{_CHANNEL} as channel"),
            F.expr("if(event_type = 'view', 'impression', 'click') as event_type"),
            "user_id",
            F.expr(f"{pick(DEVICES, 'user_id')} as device"),
            F.expr(f"{_EVENT_COST} as cost_usd"),
        )
    )


def conversions_of(events: DataFrame) -> DataFrame:
    """Purchases and signups as conversions; a signup is a new customer."""
    return (
        events.where("event_type in ('purchase', 'signup')")
        .selectExpr("*", f"{_SLOT} as slot")
        .select(
            short_id("event_id", SALT, "cv_").alias("conversion_id"),
            F.expr("cast(ts as date) as conversion_date"),
            F.expr(_CAMPAIGN_ID),
            F.expr(f"{_CHANNEL} as channel"),
            "user_id",
            F.expr("event_type as conversion_type"),
            F.expr("value as conversion_value_usd"),
            F.expr("if(event_type = 'signup', 1, 0) as is_new_customer"),
        )
    )


def contributions_of(events: DataFrame) -> DataFrame:
    """What each event adds to the measures of its campaign and day, in one pass over the log."""
    view, click, sold = "event_type = 'view'", "event_type = 'click'", "event_type in ('purchase', 'signup')"
    return events.selectExpr("*", f"{_SLOT} as slot").selectExpr(
        _CAMPAIGN_ID,
        "slot",
        "cast(ts as date) as date",
        f"if({view} or {click}, 1L, 0L) as ad_rows",
        f"if({view} or {click}, {money_units(_EVENT_COST)}, 0L) as spend_units",
        f"if({view}, 1L, 0L) as impressions",
        f"if({click}, 1L, 0L) as clicks",
        f"if({sold}, 1L, 0L) as orders",
        f"if({sold}, {money_units('value')}, 0L) as revenue_units",
        "if(event_type = 'signup', 1L, 0L) as new_customers",
    )


def _campaigns_of(slots: DataFrame) -> DataFrame:
    return (
        slots.select("slot")
        .distinct()
        .selectExpr(
            _CAMPAIGN_ID,
            f"concat({_CHANNEL}, ' Campaign ', {_NUMBER}) as campaign_name",
            f"{_CHANNEL} as channel",
            f"{pick(CAMPAIGN_TYPES, 'slot div 4')} as campaign_type",
            f"{pick(STATUSES, 'slot div 4')} as status",
            f"{pick(DAILY_BUDGETS, 'slot div 4')} as daily_budget_usd",
        )
    )


def from_events(spark: SparkSession, sf_dir: str) -> RawTables:
    events = table(spark, sf_dir, "events")
    span = lambda: events.selectExpr(
        "min(cast(ts as date)) as first_day", "max(cast(ts as date)) as last_day"
    )
    return RawTables(
        sf_dir,
        campaigns=lambda: _with_span(_campaigns_of(events.selectExpr(f"{_SLOT} as slot")), span()),
        ad_events=lambda: ad_events_of(events),
        conversions=lambda: conversions_of(events),
        span=span,
        cells=lambda: daily_cells(contributions_of(events)),
    )


def from_stored_events(spark: SparkSession, sf_dir: str) -> RawTables:
    """The same tables over cells that are written once; only whole raw tables are read from the log again."""
    events = table(spark, sf_dir, "events")
    cells = _stored(daily_cells(contributions_of(events), "slot"))
    span = cells.selectExpr("min(date) as first_day", "max(date) as last_day")
    return RawTables(
        sf_dir,
        campaigns=lambda: _with_span(_campaigns_of(cells), span),
        ad_events=lambda: ad_events_of(events),
        conversions=lambda: conversions_of(events),
        span=lambda: span,
        cells=lambda: cells,
    )


def _stored(cells: DataFrame) -> DataFrame:
    path = scratch_dir(cells.sparkSession, "cells")
    files.write_parquet(cells, path)
    return files.read_parquet(cells.sparkSession, path, cells.schema)


# --- order lines as several years of ad traffic ------------------------------


def _ad_lines(lines: DataFrame) -> DataFrame:
    """Lines not returned. A click (A) costs a hundredth of the price, an
    impression (N) a ten-thousandth, to the six decimals that this has."""
    return lines.where("l_returnflag in ('A', 'N')").selectExpr(
        "cast(l_suppkey as string) as campaign_id",
        "cast(l_shipdate as date) as event_date",
        "if(l_returnflag = 'N', 'impression', 'click') as event_type",
        f"{_LINE_COST} as cost_usd",
    )


# Test prices have whole cents; these are the doubles nearest to the shares of them.
_LINE_COST = "rint(l_extendedprice * 100) / if(l_returnflag = 'N', 1000000, 10000)"


def _line_contributions(lines: DataFrame) -> DataFrame:
    """What each line adds to the measures of its campaign and day, in one pass."""
    ad, sold = "l_returnflag in ('A', 'N')", "l_returnflag = 'R'"
    return lines.selectExpr(
        "cast(l_suppkey as string) as campaign_id",
        "cast(l_shipdate as date) as date",
        f"if({ad}, 1L, 0L) as ad_rows",
        f"if({ad}, {money_units(_LINE_COST)}, 0L) as spend_units",
        "if(l_returnflag = 'N', 1L, 0L) as impressions",
        "if(l_returnflag = 'A', 1L, 0L) as clicks",
        f"if({sold}, 1L, 0L) as orders",
        f"if({sold}, {money_units('l_extendedprice')}, 0L) as revenue_units",
        f"if({sold} and l_linenumber = 1, 1L, 0L) as new_customers",
    )


def _conversion_lines(lines: DataFrame) -> DataFrame:
    return lines.where("l_returnflag = 'R'").selectExpr(
        "cast(l_suppkey as string) as campaign_id",
        "cast(l_shipdate as date) as conversion_date",
        "l_extendedprice as conversion_value_usd",
        "if(l_linenumber = 1, 1, 0) as is_new_customer",
    )


def _supplier_campaigns(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    return (
        supplier.join(nation, F.expr("s_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .selectExpr(
            "cast(s_suppkey as string) as campaign_id",
            "s_name as campaign_name",
            "r_name as channel",
            f"{pick(CAMPAIGN_TYPES, 's_suppkey')} as campaign_type",
            f"{pick(STATUSES, 's_suppkey')} as status",
            f"{pick(DAILY_BUDGETS, 's_suppkey')} as daily_budget_usd",
        )
    )


def _suppliers_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplier_campaigns(*(table(spark, sf_dir, t) for t in ("supplier", "nation", "region")))


def from_lineitem(spark: SparkSession, sf_dir: str) -> RawTables:
    lines = table(spark, sf_dir, "lineitem")
    span = lambda: lines.selectExpr(
        "min(cast(l_shipdate as date)) as first_day", "max(cast(l_shipdate as date)) as last_day"
    )
    return RawTables(
        sf_dir,
        campaigns=lambda: _with_span(_suppliers_of(spark, sf_dir), span()),
        ad_events=lambda: _ad_lines(lines),
        conversions=lambda: _conversion_lines(lines),
        span=span,
        cells=lambda: daily_cells(_line_contributions(lines)),
    )


def from_stored_lineitem(spark: SparkSession, sf_dir: str) -> RawTables:
    """The same tables over cells that are written once."""
    lines = table(spark, sf_dir, "lineitem")
    cells = _stored(daily_cells(_line_contributions(lines)))
    span = cells.selectExpr("min(date) as first_day", "max(date) as last_day")
    return RawTables(
        sf_dir,
        campaigns=lambda: _with_span(_suppliers_of(spark, sf_dir), span),
        ad_events=lambda: _ad_lines(lines),
        conversions=lambda: _conversion_lines(lines),
        span=lambda: span,
        cells=lambda: cells,
    )


# --- customers as users ------------------------------------------------------


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, keyed the way the events name them."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customer.join(nation, F.expr("c_nationkey = n_nationkey"), "left").selectExpr(
        "c_custkey as user_id",
        "c_name as user_name",
        "n_name as country_code",
        "lower(c_mktsegment) as acquisition_channel",
        "c_acctbal as lifetime_value_usd",
    )


def masked_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension with the personal name replaced by its mask."""
    return users(spark, sf_dir).select(
        mask("user_name", SALT).alias("user_id"),
        F.expr(f"{pick(AGE_BANDS, 'user_id')} as age_band"),
        F.expr(f"{pick(GENDERS, 'user_id')} as gender"),
        "country_code",
        "acquisition_channel",
        "lifetime_value_usd",
    )


def masked_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension under the masked key that masked events carry."""
    return masked_key(users(spark, sf_dir), SALT).drop("user_name")


def masked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad events with their user ids masked."""
    return masked_key(ad_events_of(table(spark, sf_dir, "events")), SALT)
