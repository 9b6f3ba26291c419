"""Every registered query against its DuckDB SQL."""

import pytest
from compare import connect, difference
from conftest import SF, SF_SMALL, plan_of

import __spark_entry__ as registry
import oracles

QUERIES, SQL = registry.ad_queries(), oracles.oracle_sql()
HEADLINE = [
    "fact_campaign_daily", "fact_campaign_daily_b", "mart_campaign_summary_b", "daily_trend", "dq_pk_duplicates_b",
]
PLANS = ["fact_campaign_daily", "mart_channel_summary_b", "roas_by_geo", "dq_totals_reconcile"]


@pytest.fixture(scope="module")
def small():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, name):
    assert difference(QUERIES[name](spark, SF_SMALL), small, SQL[name]) is None


@pytest.mark.parametrize("name", HEADLINE)
def test_matches_sql_on_more_rows(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_gives_four_channels(spark):
    assert registry.entry(spark).count() == 4


def test_totals_at_the_larger_scale(spark):
    rows = {r.channel: r for r in QUERIES["mart_channel_summary"](spark, SF).collect()}
    google = rows["Google"]
    assert (google.total_spend_usd, google.total_revenue_usd) == (24420.7673, 35991.21)
    assert (google.roas, google.cac, google.conv_rate_pct, google.ctr_pct) == (1.47, 67.65, 152.59, 92.0)


@pytest.mark.parametrize("name", PLANS)
def test_plans_stay_in_the_jvm_and_join_on_keys(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_unused_work_leaves_the_plan(spark):
    """Daily spend by channel needs neither conversions nor campaign keys."""
    plan = plan_of(QUERIES["channel_daily_share"](spark, SF_SMALL))
    assert "purchase" not in plan
    assert "row_number" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["event_agg"](spark, SF_SMALL))
    assert "PushedFilters: [In(event_type, [click,view])]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in plan
