"""A campaign and a user that hold a third of all rows."""

from collections import Counter

import pandas as pd
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from spendlight.operators import periods, quality, star
from spendlight.session import scratch_dir
from spendlight.sources import files

ROWS = 30_000


@pytest.fixture(scope="module")
def ads(spark):
    hot = "if(id % 3 = 0, 'hot', concat('c', cast(id % 97 as string)))"
    return spark.range(ROWS, numPartitions=8).selectExpr(
        f"{hot} as campaign_id",
        "if(id % 3 = 1, 0L, id % 500) as user_id",
        "date_add(date'2024-01-01', cast(id % 40 as int)) as event_date",
        "if(id % 7 = 0, 'click', 'impression') as event_type",
        "cast(id % 1000 as double) / 100 as cost_usd",
    )


@pytest.fixture(scope="module")
def sold(ads):
    return ads.where("event_type = 'click'").selectExpr(
        "campaign_id", "user_id", "event_date as conversion_date", "cost_usd * 2 as conversion_value_usd",
        "1 as is_new_customer",
    )


def test_rollup_matches_brute_force(ads):
    rows = ads.toPandas()
    rows["impressions"] = rows.event_type == "impression"
    expected = rows.groupby(["campaign_id", "event_date"]).agg(
        spend=("cost_usd", "sum"), impressions=("impressions", "sum"), n=("impressions", "size")
    )
    found = star.event_rollup(ads).toPandas().set_index(["campaign_id", "event_date"]).loc[expected.index]
    pd.testing.assert_series_equal(found.spend_usd.astype(float), expected.spend, check_names=False, rtol=1e-9)
    assert (found.impressions == expected.impressions).all()
    assert (found.impressions + found.clicks == expected.n).all()


def test_hot_rows_are_combined_before_the_shuffle(ads):
    plan = plan_of(star.event_rollup(ads))
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(campaign_id")


def test_geo_keeps_every_event(spark, ads, sold):
    users = spark.range(400).selectExpr("id as user_id", "concat('geo', cast(id % 5 as string)) as geo")
    geo = periods.roas_by_geo(ads, sold, users, place="geo")
    assert geo.agg(F.sum(F.col("impressions") + F.col("clicks"))).first()[0] == ROWS
    assert geo.agg(F.sum("orders")).first()[0] == sold.count()
    assert geo.where("geo is null").count() == 1  # users 400 to 499 are unknown


def test_orphans_of_a_hot_value(spark, ads):
    known = spark.createDataFrame([(f"c{i}",) for i in range(97)], "campaign_id string")
    row = quality.orphans(ads, "campaign_id", known, "ads").first()
    assert (row.n_checked, row.n_failed) == (ROWS, ROWS // 3)


def test_a_hot_date_is_written_by_several_tasks(spark):
    path = scratch_dir(spark, "hot-date")
    rows = spark.range(200_000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 'a', 'b') as channel",
        "sha1(cast(id as string)) as value",
        "if(id % 3 = 0, date'2024-01-01', date_add(date'2024-02-01', cast(id % 30 as int))) as date",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    try:
        files.write_by_date(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(path)
    per_date = Counter(name.split("date=")[1][:10] for name in written.inputFiles())
    assert per_date["2024-01-01"] > 1
    assert written.selectExpr("count(*)", "count(distinct value)").first() == (200_000, 200_000)
