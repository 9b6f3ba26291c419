"""Totals and marts kept from changed days."""

import random
from datetime import date, timedelta

from conftest import plan_of
from pyspark.sql import functions as F
from test_build import DAYS, raw_rows, write_raw

from spendlight.operators import increments, marts
from spendlight.plans import build
from spendlight.session import scratch_dir


def facts(spark, rows):
    """Fact rows of (campaign, day, channel, dollars, n)."""
    schema = "campaign_key long, date date, channel string, campaign_type string, usd string, n long"
    df = spark.createDataFrame([(c, d, ch, "x", str(usd), n) for c, d, ch, usd, n in rows], schema)
    money, counts = F.col("usd").cast("decimal(28,8)"), ["impressions", "clicks", "orders", "new_customers"]
    return df.select(
        "campaign_key", "date", F.date_format("date", "yyyyMMdd").cast("int").alias("date_key"), "channel",
        "campaign_type", money.alias("spend_usd"), (money * 2).cast("decimal(28,8)").alias("revenue_usd"),
        *(F.col("n").alias(c) for c in counts),
    )


def test_totals_over_many_changes_equal_those_of_the_fact(spark):
    rng = random.Random(4)
    days = [date(2026, 1, 1) + timedelta(days=i) for i in range(6)]

    def day_rows(d):
        return [
            (c, d, rng.choice(["Meta", "Google", None]), rng.choice(["0.00000001", "12345678901.99999999", "-3.5"]), c)
            for c in range(8)
            if rng.random() < 0.5
        ]

    now = {d: day_rows(d) for d in days}
    every = lambda: facts(spark, [r for rows in now.values() for r in rows])
    kept = {tuple(by): increments.totals(every(), by) for by in (increments.BY_CAMPAIGN, increments.BY_DAY)}
    for _ in range(3):
        changed = rng.sample(days, 2)
        old = facts(spark, [r for d in changed for r in now[d]])
        now |= {d: day_rows(d) for d in changed}
        new = facts(spark, [r for d in changed for r in now[d]])
        for by, before in kept.items():
            after = increments.after(before, old, new, list(by))
            rows, schema = after.collect(), after.schema
            assert sorted(rows, key=str) == sorted(increments.totals(every(), list(by)).collect(), key=str)
            kept[by] = spark.createDataFrame(rows, schema)


def test_groups_without_rows_are_gone_and_no_change_changes_nothing(spark):
    day = date(2026, 1, 1)
    rows = facts(spark, [(1, day, "Meta", "1.5", 0), (2, day, "Meta", "0", 0)])
    none = rows.where("false")
    before = increments.totals(rows, increments.BY_CAMPAIGN)
    assert sorted(increments.after(before, none, none, increments.BY_CAMPAIGN).collect()) == sorted(before.collect())
    # A campaign with only zeros in its rows still has rows.
    left = increments.after(before, rows.where("campaign_key = 1"), none, increments.BY_CAMPAIGN)
    assert [(r.campaign_key, r.n_rows) for r in left.collect()] == [(2, 1)]
    assert increments.after(before, rows, none, increments.BY_CAMPAIGN).collect() == []
    assert increments.after(before.where("false"), none, none, increments.BY_CAMPAIGN).collect() == []


def test_marts_after_a_partial_run_equal_those_of_a_full_one(spark, monkeypatch):
    rows, output = raw_rows(), scratch_dir(spark, "out")
    build.run(spark, write_raw(spark, rows), output, "spendlight_kept", "salt", version="v1")
    # On a day one campaign loses its ad events and two get more.
    day = DAYS[3]
    rows["fact_ad_events"] = [r for r in rows["fact_ad_events"] if r[1] != day or r[2] != "camp_1"] + [
        (f"ev_late_{n}", day, f"camp_{n % 2 * 2}", "Meta", "click", "u1", "mobile", "US", 0.07, 0.0, 0)
        for n in range(9)
    ]
    raw, read = write_raw(spark, rows), []
    # As if a run had ended between two publications: the totals in use are those of the fact's version.
    spark.sql("DROP VIEW spendlight_kept.totals_by_day")
    after = increments.after

    def watched(before, removed, added, by):
        read.append((removed.inputFiles(), added.inputFiles(), plan_of(removed)))
        return after(before, removed, added, by)

    with monkeypatch.context() as patch:
        patch.setattr(increments, "after", watched)
        report = build.run(
            spark, raw, output, "spendlight_kept", "salt", dates=(day.isoformat(), day.isoformat()), version="v2"
        )
    assert [r for r in report.collect() if r.n_failed] == []
    build.run(spark, raw, scratch_dir(spark, "out"), "spendlight_full", "salt", version="v1")
    for name in ("mart_channel_summary", "mart_campaign_summary", "mart_monthly_summary", *build.TOTALS):
        kept, full = (spark.table(f"{db}.{name}") for db in ("spendlight_kept", "spendlight_full"))
        assert kept.schema == full.schema
        assert sorted(kept.collect()) == sorted(full.collect())
    assert len(read) == len(build.TOTALS)
    for removed, added, plan in read:
        assert added and all("/v2/" in f and f"date={day}" in f for f in added)
        assert "PartitionFilters: [isnotnull(date" in plan


def test_marts_from_totals_equal_those_from_the_fact(spark):
    output = scratch_dir(spark, "out")
    build.run(spark, write_raw(spark, raw_rows()), output, "spendlight_totals", "salt", version="v1")
    fact, dim, days = (
        spark.table(f"spendlight_totals.{t}") for t in ("fact_campaign_daily", "dim_campaign", "dim_date")
    )
    straight = {
        "mart_channel_summary": marts.channel_summary(fact),
        "mart_campaign_summary": marts.campaign_summary(fact, dim),
        "mart_monthly_summary": marts.monthly_summary(fact, days),
    }
    for name, mart in straight.items():
        assert sorted(mart.collect()) == sorted(spark.table(f"spendlight_totals.{name}").collect())
