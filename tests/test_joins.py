"""Joins with a dimension of counted size, and filters that reach the folders."""

from conftest import plan_of

import __spark_entry__ as registry
from spendlight.operators import reports, star
from spendlight.operators.joins import broadcast_if_small, counted_bytes

SF = "/root/testdata/sf0.001"


def test_bytes_are_counted(spark):
    rows = spark.createDataFrame([(1, "ab"), (2, None), (None, "\u00e9\u00e9\u00e9")], "n long, s string")
    assert counted_bytes(rows) == 3 * 32 + 2 + 6
    assert counted_bytes(rows.limit(0)) == 0


def test_the_fact_side_is_shuffled_only_beyond_the_limit(spark):
    m = registry.Model(registry.adapters.from_stored_events(spark, SF))
    folder, tables = registry._stored_star(spark, SF)
    dim = tables["dim_campaign"]
    small = star.fact_of_cells(m.raw.cells, broadcast_if_small(dim))
    plan = plan_of(small)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Sort" not in plan
    large = star.fact_of_cells(m.raw.cells, broadcast_if_small(dim, 10))
    assert "SortMergeJoin" in plan_of(large)
    assert sorted(small.collect()) == sorted(large.collect())


def test_a_range_of_date_keys_reads_its_folders(spark):
    _, tables = registry._stored_star(spark, SF)
    fact = tables["fact_campaign_daily"]
    ask = lambda a, b: reports.roas_filtered(fact, tables["dim_campaign"], "Meta", "prospecting", a, b)
    plan = plan_of(ask(20240110, 20240112))
    scan = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "date" in scan and ">= 2024-01-10" in scan and "<= 2024-01-12" in scan
    assert ask(20240100, 20249999).collect() == ask(20240101, 20241231).collect() == ask(0, 99999999).collect()
    total = fact.where("date_key between 20240110 and 20240112 and channel = 'Meta' and campaign_type = 'prospecting'")
    assert ask(20240110, 20240112).first().spend_usd == total.agg({"spend_usd": "sum"}).first()[0]
