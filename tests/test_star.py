from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import AD_EVENTS, CAMPAIGNS, CONVERSIONS
from pyspark.sql import functions as F

from spendlight.operators import marts, periods, reports, star
from spendlight.operators.keys import with_dense_key
from spendlight.sources import adapters

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2025, 1, 1)


@pytest.fixture
def dim(frame):
    rows = [
        ("c2", "Beta", "Meta", "performance", "active", D1, D3, 500),
        ("c1", "Alpha", "Google", "prospecting", "paused", D1, D3, 1000),
    ]
    return star.campaign_dimension(frame(rows, CAMPAIGNS))


@pytest.fixture
def fact(frame, dim):
    ads = [
        ("c1", D1, "impression", 0.0105),
        ("c1", D1, "click", 2.0),
        ("c1", D2, "impression", 0.0),  # spent nothing
        ("c2", D1, "click", 1.0),
        ("c2", D3, "click", -5.0),  # refund
        ("c9", D1, "click", 3.0),  # not in the dimension
        (None, D1, "click", 4.0),
    ]
    sold = [
        ("c1", D1, 10.0, 1),
        ("c1", D1, 5.5, 0),
        ("c2", D2, 99.0, 1),  # no ad events that day
        ("c2", D3, 7.0, 0),
        (None, D1, 50.0, 1),
    ]
    return star.campaign_daily_fact(frame(ads, AD_EVENTS), frame(sold, CONVERSIONS), dim)


def test_campaign_keys_follow_the_id(dim):
    assert [(r.campaign_key, r.campaign_id) for r in dim.orderBy("campaign_key").collect()] == [(1, "c1"), (2, "c2")]


def test_fact_cells(fact):
    rows = {(r.campaign_key, r.date, r.spend_usd): r for r in fact.collect()}
    assert len(rows) == 6

    full = rows[1, D1, Decimal("2.0105")]
    assert (full.impressions, full.clicks, full.orders, full.new_customers) == (1, 1, 2, 1)
    assert (full.revenue_usd, full.date_key, full.channel) == (Decimal("15.5"), 20240101, "Google")
    assert (full.roas, full.cac, full.conv_rate_pct, full.ctr_pct) == (7.71, 2.01, 200.0, 100.0)

    free = rows[1, D2, Decimal("0")]
    assert (free.orders, free.revenue_usd, free.new_customers) == (0, 0, 0)
    assert (free.roas, free.cac, free.conv_rate_pct, free.ctr_pct) == (None, None, None, 0.0)

    assert rows[2, D1, Decimal("1")].orders == 0
    refund = rows[2, D3, Decimal("-5")]
    assert (refund.revenue_usd, refund.roas, refund.conv_rate_pct) == (7, None, 100.0)

    # Unknown and missing campaigns stay, without key and without conversions.
    assert rows[None, D1, Decimal("3")].channel is None
    assert rows[None, D1, Decimal("4")].orders == 0


def test_zero_policy(frame, dim):
    ads = frame([("c1", D1, "impression", 0.0)], AD_EVENTS)
    row = star.campaign_daily_fact(ads, frame([], CONVERSIONS), dim, on_zero="zero").first()
    assert (row.roas, row.cac, row.conv_rate_pct, row.ctr_pct) == (0.0, 0.0, 0.0, 0.0)


def test_empty_input(frame, dim):
    fact = star.campaign_daily_fact(frame([], AD_EVENTS), frame([], CONVERSIONS), dim)
    assert fact.count() == 0
    kpis = reports.overall_kpis(marts.channel_summary(fact))
    assert tuple(kpis.select("total_orders", "roas", "cac", "conv_rate_pct", "ctr_pct").first()) == (0, 0, 0, 0, 0)
    assert [r.pct_of_impressions for r in reports.conversion_funnel(kpis).collect()] == [0.0] * 4


def test_january_of_two_years_stays_apart(frame, fact):
    days = star.date_dimension(frame([(D1,), (D2,), (D3,)], "date_id date"))
    months = marts.monthly_summary(fact, days).where("channel = 'Meta'").collect()
    assert [(r.year, r.month, r.month_name) for r in months] == [(2024, 1, "January"), (2025, 1, "January")]


def test_week_that_spans_new_year_is_one(frame):
    measures = (
        "spend_usd double, revenue_usd double, impressions bigint, clicks bigint, orders bigint, new_customers bigint"
    )
    rows = [(date(2024, 12, 31), "Meta", 1.0, 1.0, 1, 1, 1, 1), (date(2025, 1, 2), "Meta", 1.0, 1.0, 1, 1, 1, 1)]
    weeks = periods.weekly_summary(frame(rows, f"date date, channel string, {measures}")).collect()
    assert [(r.week_start, r.orders) for r in weeks] == [(date(2024, 12, 30), 2)]


def test_ranking_ties_nulls_and_short_input(frame):
    schema = (
        "campaign_key bigint, campaign_name string, channel string, campaign_type string, roas double,"
        " total_spend_usd double, total_revenue_usd double"
    )
    rows = [(k, f"n{k}", "Meta", "performance", r, 1.0, 1.0) for k, r in [(4, 2.0), (2, 2.0), (3, None), (1, 0.5)]]
    campaigns = frame(rows, schema)
    ranked = lambda k, best: [
        (r["rank"], r.campaign_key) for r in reports.ranked_by_roas(campaigns, k, best).orderBy("rank").collect()
    ]
    assert ranked(5, True) == [(1, 2), (2, 4), (3, 1), (4, 3)]
    assert ranked(2, False) == [(1, 1), (2, 2)]
    assert [r.campaign_key for r in reports.roas_alerts(campaigns).collect()] == [1]


def test_trend_averages_rows_that_have_a_roas(frame):
    rows = [(D1, 1.0, 1.0, 1.0), (D1, 1.0, 2.0, 2.0), (D1, 0.0, 5.0, None)]
    daily = frame(rows, "date date, spend_usd double, revenue_usd double, roas double")
    assert tuple(reports.daily_trend(daily).first()) == (D1, 2.0, 8.0, 1.5)


@pytest.mark.parametrize("count, slices", [(0, 4), (1, 4), (3, 4), (5000, 16), (5000, 256)])
def test_dense_key_is_the_rank(spark, count, slices):
    ids = spark.range(count).select(F.concat(F.lit("camp_"), F.md5(F.col("id").cast("string"))).alias("id"))
    keyed = {r.id: r.key for r in with_dense_key(ids.repartition(5), "key", "id", slices).collect()}
    assert keyed == {name: i for i, name in enumerate(sorted(keyed), 1)}
    assert len(keyed) == count


def test_dense_key_ignores_the_partitioning(spark):
    ids = spark.range(2000).select(F.sha1(F.col("id").cast("string")).alias("id"))
    one = with_dense_key(ids.coalesce(1), "key", "id").collect()
    many = with_dense_key(ids.repartition(13), "key", "id").collect()
    assert sorted(one) == sorted(many)


def test_prior_month_is_the_calendar_month_before(frame):
    rows = [(2024, m, "Meta", 1.0, r, r) for m, r in [(1, 1.0), (2, 1.5), (4, 3.0)]]
    rows += [(2025, 1, "Meta", 1.0, 2.0, 2.0)]
    rows += [(2023, 12, "Google", 1.0, 4.0, 4.0), (2024, 1, "Google", 1.0, 3.0, 3.0)]
    months = frame(rows, "year int, month int, channel string, spend_usd double, revenue_usd double, roas double")
    prior = periods.with_prior_month(months).collect()
    found = {(r.channel, r.year, r.month): (r.prior_roas, r.roas_change) for r in prior}
    assert found == {
        ("Meta", 2024, 1): (None, None), ("Meta", 2024, 2): (1.0, 0.5), ("Meta", 2024, 4): (None, None),
        ("Meta", 2025, 1): (None, None), ("Google", 2023, 12): (None, None), ("Google", 2024, 1): (4.0, -1.0),
    }


def test_long_campaign_numbers_stay_whole(spark):
    events = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), 1, "view", 1.0, f'{{"k": {(n - 1) * 4}}}') for n in (7, 100, 1000)],
        adapters.SCHEMAS["events"],
    )
    found = {r.campaign_id for r in adapters.ad_events_of(events).collect()}
    assert found == {"camp_ME_007", "camp_ME_100", "camp_ME_1000"}
    assert found == {r.campaign_id for r in adapters.contributions_of(events).collect()}
