from datetime import date
from decimal import Decimal

import pytest

from spendlight.functions import calendar_columns, date_key, mask, money_sum, ratio, short_id
from spendlight.functions.labels import channel_color, roas_band, roas_color, roas_direction, roas_status, roas_verdict


def value(spark, sql, *columns):
    return spark.sql(sql).select(*columns).first()


@pytest.mark.parametrize(
    "top, bottom, expected",
    [
        ("4.89", "2.0", 2.45),  # 2.445 rounds half up
        ("1.005", "1.0", 1.01),
        ("0.0", "5.0", 0.0),
        ("5.0", "0.0", None),
        ("5.0", "-2.0", None),
        ("cast(null as decimal(4,2))", "2.0", None),
        ("2.0", "cast(null as decimal(4,2))", None),
        ("1.0049", "1.0", 1.0),
    ],
)
def test_ratio(spark, top, bottom, expected):
    assert value(spark, f"select {top} as n, {bottom} as d", ratio("n", "d"))[0] == expected


def test_ratio_zero_policy(spark):
    zero = lambda sql: value(spark, sql, ratio("n", "d", on_zero="zero"))[0]
    assert zero("select 5.0 as n, 0.0 as d") == 0.0
    assert zero("select 5.0 as n, -1.0 as d") == 0.0
    assert zero("select 5.0 as n, cast(null as decimal(4,2)) as d") == 0.0
    assert zero("select 5.0 as n, 4.0 as d") == 1.25
    with pytest.raises(ValueError):
        ratio("n", "d", on_zero="one")


def test_percent_of_large_counts(spark):
    assert value(spark, "select 3000000000000L as n, 7000000000000L as d", ratio("n", "d", factor=100))[0] == 42.86


def test_money_sum_does_not_depend_on_order(spark, frame):
    rows = [(0.1,), (1e9,), (0.2,), (-1e9,), (0.3333,)] * 200
    forward = frame(rows, "v double").select(money_sum("v")).first()[0]
    backward = frame(rows[::-1], "v double").repartition(7).select(money_sum("v")).first()[0]
    assert forward == backward
    assert forward == Decimal("126.66")


@pytest.mark.parametrize("amount, total", [(0.00004, "40"), (0.00125678, "1256.78"), (0.00000001, "0.01")])
def test_money_sum_keeps_what_a_single_impression_costs(spark, amount, total):
    rows = spark.range(1_000_000).selectExpr(f"cast({amount} as double) as v")
    assert rows.select(money_sum("v")).first()[0] == Decimal(total)


def test_money_sum_of_a_very_large_group(spark, frame):
    rows = frame([(9.0e10,), (0.00000001,), (-1.5,)] * 3, "v double").crossJoin(spark.range(1000))
    assert rows.select(money_sum("v")).first()[0] == Decimal("269999999995500.00003")


def test_money_sum_of_nothing_is_null(spark, frame):
    assert frame([(None,)], "v double").select(money_sum("v")).first()[0] is None
    assert frame([], "v double").select(money_sum("v")).first()[0] is None


@pytest.mark.parametrize(
    "day, key, weekday, weekend, week",
    [
        (date(2024, 1, 1), 20240101, 0, 0, 1),
        (date(2023, 1, 1), 20230101, 6, 1, 52),
        (date(2024, 12, 30), 20241230, 0, 0, 1),
        (date(2024, 2, 29), 20240229, 3, 0, 9),
        (date(2026, 1, 3), 20260103, 5, 1, 1),
    ],
)
def test_calendar(spark, frame, day, key, weekday, weekend, week):
    columns = calendar_columns("d")
    parts = [column.alias(name) for name, column in columns.items()]
    row = frame([(day,)], "d date").select(date_key("d").alias("key"), *parts).first()
    assert (row.key, row.day_of_week, row.is_weekend, row.week_of_year) == (key, weekday, weekend, week)
    assert (row.day_name, row.month_name) == (day.strftime("%A"), day.strftime("%B"))
    assert (row.year, row.month, row.day_of_month, row.quarter) == (day.year, day.month, day.day, (day.month + 2) // 3)


def test_mask(spark, frame):
    import hashlib

    row = frame([("a@b.c", None)], "v string, n string").select(
        mask("v", "s'alt"), mask("n", "s"), short_id("v", "s'alt", "ev_")
    ).first()
    digest = hashlib.sha256(b"s'alt:a@b.c").hexdigest()
    assert list(row) == [digest[:32], None, "ev_" + digest[:12]]


@pytest.mark.parametrize(
    "roas, expected",
    [
        (2.0, ("Excellent", "up", "#22c55e", "good", "2-4")),
        (9.0, ("Excellent", "up", "#22c55e", "good", "2-4")),
        (1.99, ("Good", "up", "#fbbf24", "good", "1.5-2")),
        (1.5, ("Good", "up", "#fbbf24", "good", "1.5-2")),
        (1.49, ("Break-even", "neutral", "#f97316", "bad", "1-1.5")),
        (1.0, ("Break-even", "neutral", "#f97316", "bad", "1-1.5")),
        (0.99, ("Poor", "down", "#ef4444", "bad", "0-1")),
        (None, ("Poor", "down", "#ef4444", "bad", "0-1")),
    ],
)
def test_levels(spark, frame, roas, expected):
    labels = [f("r") for f in (roas_status, roas_direction, roas_color, roas_verdict, roas_band)]
    assert tuple(frame([(roas,)], "r double").select(*labels).first()) == expected


def test_channel_color_has_a_default(spark, frame):
    rows = frame([("Meta",), ("Radio",), (None,)], "c string").select(channel_color("c")).collect()
    assert [r[0] for r in rows] == ["#1877f2", "#64748b", "#64748b"]
