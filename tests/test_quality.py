from datetime import date

from conftest import AD_EVENTS, CONVERSIONS

from spendlight.operators import quality

DAY = date(2024, 1, 1)


def report(df):
    return {r.check_name: (r.n_checked, r.n_failed) for r in df.collect()}


def test_row_counts(frame):
    three = frame([(1,), (2,), (3,)], "x int")
    assert report(quality.row_counts({"t": three}, {"t": 2})) == {"rows:t": (3, 0)}
    assert report(quality.row_counts({"t": three}, {"t": 10})) == {"rows:t": (3, 7)}


def test_masked_ids_checks_every_row(frame):
    rows = [("0123456789abcdef" * 2,), ("0123456789ABCDEF" * 2,), ("ab",), ("user@example.com",), (None,)]
    assert report(quality.masked_ids(frame(rows, "user_id string"))) == {"masked:user_id": (5, 4)}


def test_duplicate_keys(frame):
    rows = [(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)]
    assert report(quality.duplicate_keys(frame(rows, "a int, b int"), ["a", "b"], "t")) == {"unique:t(a,b)": (6, 2)}
    assert report(quality.duplicate_keys(frame([], "a int, b int"), ["a"], "t")) == {"unique:t(a)": (0, 0)}


def test_not_null(frame):
    rows = [(1, None), (2, "x"), (None, None)]
    assert report(quality.not_null(frame(rows, "a int, b string"), ["a", "b"], "t")) == {
        "not_null:t.a": (3, 1),
        "not_null:t.b": (3, 2),
    }


def test_orphans_count_rows_and_nulls(frame):
    child, parent = frame([(1,), (1,), (7,), (7,), (None,)], "k int"), frame([(1,), (2,)], "k int")
    assert report(quality.orphans(child, "k", parent, "t")) == {"orphans:t.k": (5, 3)}


def test_domains(frame):
    rows = [(1, "a"), (5, "z"), (None, None)]
    found = report(quality.domains(frame(rows, "q int, c string"), {"q": (1, 4), "c": ["a", "b"]}, "t"))
    assert found == {"domain:t.q": (3, 1), "domain:t.c": (3, 1)}


def test_metrics_reconcile_finds_wrong_and_missing_values(frame):
    schema = (
        "spend_usd double, revenue_usd double, impressions bigint, clicks bigint, orders bigint, new_customers bigint,"
        " roas double, cac double, conv_rate_pct double, ctr_pct double"
    )
    rows = [
        (2.0, 3.0, 10, 5, 1, 1, 1.5, 2.0, 20.0, 50.0),
        (2.0, 3.0, 10, 5, 1, 1, 1.51, 2.0, 20.0, 50.0),
        (0.0, 3.0, 10, 5, 1, 0, None, None, 20.0, 50.0),
        (2.0, 3.0, 10, 5, 1, 1, None, 2.0, 20.0, 50.0),
    ]
    found = report(quality.metrics_reconcile(frame(rows, schema)))
    assert found["metric:roas"] == (4, 2)
    assert found["metric:cac"] == found["metric:ctr_pct"] == (4, 0)
    assert report(quality.metrics_reconcile(frame(rows, schema), tolerance=0.02))["metric:roas"] == (4, 1)


def test_dropped_conversions(frame):
    ads = frame([("c1", DAY, "click", 1.0)], AD_EVENTS)
    sold = frame([("c1", DAY, 10.0, 1), ("c2", DAY, 5.0, 0), ("c2", DAY, 6.0, 1), (None, DAY, 1.0, 0)], CONVERSIONS)
    assert report(quality.dropped_conversions(ads, sold)) == {
        "dropped:cells": (3, 2),
        "dropped:orders": (4, 3),
        "dropped:revenue_usd": (22.0, 12.0),
        "dropped:new_customers": (2, 1),
    }


def test_totals_reconcile_finds_a_wrong_mart(frame):
    fact = frame([(1.0,), (2.0,)], "spend_usd double")
    marts = {"good": frame([(3.0,)], "total_spend_usd double"), "bad": frame([(2.9,)], "spend_usd double")}
    found = {r.check_name: r.n_failed for r in quality.totals_reconcile(fact, marts, ["spend_usd"]).collect()}
    assert found == {"totals:good.spend_usd": 0, "totals:bad.spend_usd": 1}


def test_amounts_finer_than_a_unit_are_counted(frame):
    rows = [(0.00000125,), (0.000000001,), (12.5,), (None,)]
    assert report(quality.money_on_grid(frame(rows, "c double"), ["c"], "t")) == {"grid:t.c": (4, 1)}


def test_orders_are_conversions(frame):
    cells = frame([(1, 2), (0, 3)], "ad_rows long, orders long")
    fact = frame([(2,)], "orders long")
    sold = lambda n: frame([(i,) for i in range(n)], "x int")
    assert report(quality.orders_are_conversions(fact, cells, sold(5))) == {"orders:conversions": (5, 0)}
    assert report(quality.orders_are_conversions(fact, cells, sold(7))) == {"orders:conversions": (7, 2)}


def test_rows_known_from_elsewhere(frame):
    one = frame([(4,)], "n long")
    assert report(quality.row_counts({}, {"ads": 5}, {"ads": one})) == {"rows:ads": (4, 1)}
