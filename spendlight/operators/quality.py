"""Checks over whole tables. Each gives rows (check_name, n_checked, n_failed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlight.functions.metrics import METRICS, off_grid, ratio
from spendlight.functions.privacy import MASK_PATTERN
from spendlight.operators.star import contributions, daily_cells


def _report(name: str, checked: str, failed: str, kind: str = "bigint") -> str:
    """SQL of one report row."""
    return (
        f"named_struct('check_name', '{name}', 'n_checked', cast(coalesce({checked}, 0) as {kind}),"
        f" 'n_failed', cast(coalesce({failed}, 0) as {kind}))"
    )


def _reports(one_row: DataFrame, rows: list[str]) -> DataFrame:
    return one_row.selectExpr(f"inline(array({', '.join(rows)}))")


def _union(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def _row_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Count the rows that break each rule, all rules in one pass.

    A rule holds where its condition is true or unknown.
    """
    failures = [F.count_if(~rule).alias(f"failed_{i}") for i, rule in enumerate(rules.values())]
    counts = df.agg(F.expr("count(*) as n"), *failures)
    return _reports(counts, [_report(name, "n", f"failed_{i}") for i, name in enumerate(rules)])


def row_counts(
    tables: dict[str, DataFrame], minimum: dict[str, int], counted: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Rows per table; the failures are the rows missing to the minimum.

    ``counted`` has one-row tables (n) for those whose rows are known from elsewhere.
    """
    counts = {name: df.selectExpr("count(*) as n") for name, df in tables.items()} | (counted or {})
    return _union(
        [
            _reports(counts[name], [_report(f"rows:{name}", "n", f"greatest({least} - n, 0)")])
            for name, least in minimum.items()
        ]
    )


def masked_ids(df: DataFrame, column: str = "user_id") -> DataFrame:
    """Ids that are not 32 lowercase hex digits, NULL included."""
    looks_masked = F.coalesce(F.col(column).rlike(MASK_PATTERN), F.lit(False))
    return _row_rules(df, {f"masked:{column}": looks_masked})


def metrics_reconcile(fact: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Stored ratios against ratios recomputed from the row's own measures."""

    def agrees(metric: str) -> Column:
        top, bottom, factor = METRICS[metric]
        stored, expected = F.col(metric), ratio(top, bottom, factor=factor)
        return F.coalesce(F.abs(stored - expected) <= tolerance, stored.isNull() & expected.isNull())

    return _row_rules(fact, {f"metric:{metric}": agrees(metric) for metric in METRICS})


def duplicate_keys(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Key values that occur more than once."""
    groups = df.groupBy(*keys).agg(F.expr("count(*) as n"))
    counts = groups.selectExpr("sum(n) as checked", "count_if(n > 1) as failed")
    return _reports(counts, [_report(f"unique:{name}({','.join(keys)})", "checked", "failed")])


def primary_keys(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    return _union([duplicate_keys(tables[name], columns, name) for name, columns in keys.items()])


def not_null(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    return _row_rules(df, {f"not_null:{name}.{column}": F.expr(f"{column} is not null") for column in columns})


def not_null_columns(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    return _union([not_null(tables[name], names, name) for name, names in columns.items()])


def orphans(child: DataFrame, column: str, parent: DataFrame, name: str) -> DataFrame:
    """Rows whose reference has no parent; a NULL reference counts as an orphan.

    References are counted per value before the join, so a value that fills a
    third of the table is one row in it.
    """
    references = child.groupBy(column).agg(F.expr("count(*) as n"))
    known = parent.select(column).distinct().selectExpr(column, "true as known")
    counts = references.join(known, column, "left").selectExpr(
        "sum(n) as checked", "sum(if(known, 0, n)) as failed"
    )
    return _reports(counts, [_report(f"orphans:{name}.{column}", "checked", "failed")])


def foreign_keys(tables: dict[str, DataFrame], references: list[tuple[str, str, str]]) -> DataFrame:
    return _union([orphans(tables[child], column, tables[parent], child) for child, column, parent in references])


def domains(df: DataFrame, allowed: dict[str, list | tuple], name: str) -> DataFrame:
    """Values outside a list, or outside a (low, high) pair; NULL passes."""
    rules = {
        f"domain:{name}.{column}": F.col(column).between(*values)
        if isinstance(values, tuple)
        else F.col(column).isin(list(values))
        for column, values in allowed.items()
    }
    return _row_rules(df, rules)


def dropped_cells(cells: DataFrame) -> DataFrame:
    """What the fact leaves out: conversions on a campaign and day without ad
    events, as cells, orders, revenue and new customers."""
    measures = {"cells": "1", "orders": "orders", "revenue_usd": "revenue_usd", "new_customers": "new_customers"}
    sums = cells.where("orders > 0").selectExpr(
        *[f"sum({sql}) as {name}" for name, sql in measures.items()],
        *[f"sum(if(ad_rows > 0, null, {sql})) as lost_{name}" for name, sql in measures.items()],
    )
    return _reports(sums, [_report(f"dropped:{name}", name, f"lost_{name}", "double") for name in measures])


def dropped_conversions(ad_events: DataFrame, conversions: DataFrame) -> DataFrame:
    return dropped_cells(daily_cells(contributions(ad_events, conversions)))


def orders_are_conversions(fact: DataFrame, cells: DataFrame, conversions: DataFrame) -> DataFrame:
    """Conversion rows against the fact's orders and those it leaves out, as one check."""
    counted = conversions.selectExpr("count(*) as n")
    kept, lost = fact.selectExpr("sum(orders)"), cells.where("ad_rows = 0").selectExpr("sum(orders)")
    both = counted.withColumn("found", F.coalesce(kept.scalar(), F.lit(0)) + F.coalesce(lost.scalar(), F.lit(0)))
    return _reports(both, [_report("orders:conversions", "n", "abs(n - found)")])


def money_on_grid(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Amounts finer than the unit of money, which sums would round."""
    return _row_rules(df, {f"grid:{name}.{c}": F.expr(f"not ({off_grid(c)})") for c in columns})


def totals_reconcile(fact: DataFrame, marts: dict[str, DataFrame], measures: list[str]) -> DataFrame:
    """Each mart's totals against the fact's, as (check_name, fact, mart, n_failed).

    ``marts`` hold the measures under their own or their ``total_`` names.
    """

    def totals(df: DataFrame, source: str) -> DataFrame:
        columns = [m if m in df.columns else f"total_{m}" for m in measures]
        present = [(m, c) for m, c in zip(measures, columns) if c in df.columns]
        one = df.selectExpr(*[f"cast(sum({c}) as decimal(38,8)) as {m}" for m, c in present])
        rows = ", ".join(f"'{source}', '{m}', {m}" for m, _ in present)
        return one.selectExpr(f"stack({len(present)}, {rows}) as (source, measure, total)")

    expected = totals(fact, "fact").select("measure", F.col("total").alias("fact_total"))
    found = _union([totals(df, source) for source, df in marts.items()])
    return found.join(expected, "measure").selectExpr(
        "concat('totals:', source, '.', measure) as check_name",
        "fact_total",
        "total as mart_total",
        "if(total <=> fact_total, 0L, 1L) as n_failed",
    )
