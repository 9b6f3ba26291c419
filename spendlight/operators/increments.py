"""Rollups kept from changed days: what their rows gave before is taken off, what they give now is put on.

The totals of a fact have the fact's measure names, so the marts are built from
them as from the fact, and without reading its history. Measures are whole
numbers and exact decimals: totals kept over any number of changes equal those
of the fact that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlight.operators.marts import MEASURES, measure_sums

#: The groups of the marts by channel and campaign, and of those by month. Days times channels are few.
BY_CAMPAIGN = ["campaign_key", "channel", "campaign_type"]
BY_DAY = ["date", "date_key", "channel"]


def totals(fact: DataFrame, by: list[str]) -> DataFrame:
    """Columns ``by``, n_rows and the summed measures; a grouping with a map-side step."""
    return fact.groupBy(*by).agg(F.expr("count(*) as n_rows"), *measure_sums())


def after(before: DataFrame, removed: DataFrame, added: DataFrame, by: list[str]) -> DataFrame:
    """Totals once the rows ``removed`` have gone from the fact and ``added`` have come.

    ``before`` are the totals of the whole fact, the others rows of it: those of
    the changed days as they were and as they are. Groups without a row left are
    gone, and a group of NULL keys is one like any other. What is shuffled is a
    row per group of each of the three.
    """
    less = totals(removed, by).withColumns({c: -F.col(c) for c in ["n_rows", *MEASURES]})
    every = before.unionByName(less).unionByName(totals(added, by))
    summed = every.groupBy(*by).agg(F.expr("sum(n_rows) as n_rows"), *measure_sums())
    return summed.where("n_rows > 0")
