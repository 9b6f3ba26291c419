"""Days closed by event time, what comes late, alerts on closed days, and restarts."""

from datetime import date, timedelta

from conftest import AD_EVENTS, CONVERSIONS

from spendlight.operators import star
from spendlight.session import scratch_dir
from spendlight.streaming import closed, daily

DAY = date(2024, 1, 10)
NAMES = daily.CELLS.fieldNames()


def drop(spark, paths, ads, sold):
    for path, rows, ddl in zip(paths, (ads, sold), (AD_EVENTS, CONVERSIONS)):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def streamed(spark, paths):
    session = daily.streaming_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    source = lambda path, ddl: session.readStream.schema(ddl).parquet(path)
    return star.contributions(source(paths[0], AD_EVENTS), source(paths[1], CONVERSIONS))


def rows(df):
    return sorted(map(tuple, df.select(NAMES).collect()))


def feed(spark, drops):
    """Each drop is a run of its own, started again from the checkpoint; what was closed after each."""
    paths, folder, seen = (scratch_dir(spark, "ads"), scratch_dir(spark, "sold")), scratch_dir(spark, "closed"), []
    for ads, sold in drops:
        drop(spark, paths, ads, sold)
        closed.start(streamed(spark, paths), folder).awaitTermination()
        daily.start(streamed(spark, paths), f"{folder}/all").awaitTermination()
        closed.start_alerts(daily.streaming_session(spark), folder).awaitTermination()
        seen.append(rows(closed.read_closed(spark, folder)))
    return folder, paths, seen


def ads_on(shift, cost=1.0, n=3, campaign="c"):
    return [(campaign, DAY + timedelta(days=shift), ["click", "impression"][i % 2], cost) for i in range(n)]


def sold_on(shift, value, campaign="c"):
    return [(campaign, DAY + timedelta(days=shift), value, 1)]


def test_closed_days_equal_the_batch_and_late_rows_are_told_apart(spark):
    drops = [
        (ads_on(0) + ads_on(1, campaign="d"), sold_on(0, 5.0)),
        (ads_on(1) + ads_on(3), sold_on(1, 2.0, "e")),
        (ads_on(0, n=2) + ads_on(4), sold_on(3, 1.0)),
        (ads_on(9), sold_on(9, 1.0)),
    ]
    folder, paths, seen = feed(spark, drops)
    assert seen[0] == [] and all(set(a) <= set(b) for a, b in zip(seen, seen[1:])), "a closed day never changes"
    assert len(set(seen[-1])) == len(seen[-1])
    every = star.daily_cells(star.contributions(spark.read.parquet(paths[0]), spark.read.parquet(paths[1])))
    late = {(r.campaign_id, r.date): (r.ad_rows, r.clicks, r.spend_usd) for r in
            closed.late_cells(closed.read_closed(spark, folder), every).collect()}
    assert {k: (n, c, float(s)) for k, (n, c, s) in late.items()} == {("c", DAY): (2, 1, 2.0)}
    expected = [r for r in rows(every) if DAY < r[1] <= DAY + timedelta(days=4)]
    assert [r for r in seen[-1] if r[1] > DAY] == expected
    # The deltas hold the late rows too.
    whole = {(r.campaign_id, r.date): r.clicks for r in daily.daily_metrics(spark, f"{folder}/all").collect()}
    assert whole["c", DAY] == 3


def test_one_alert_at_each_crossing(spark):
    value = {0: 9.0, 1: 0.5, 2: 0.5, 3: 0.5, 4: 0.5, 5: 18.0, 6: 0.5, 7: 0.5, 8: 0.5, 9: 0.5, 10: 0.5}
    runs = [(0, 1, 2), (3, 4, 5), (6, 7, 8, 9, 10)]
    drops = [
        ([r for d in days for r in ads_on(d)],
         [r for d in days for r in sold_on(d, value[d]) + sold_on(d, value[d], "no-ads")]) for days in runs
    ]
    drops.append((ads_on(20), sold_on(20, 1.0)))
    folder, _, _ = feed(spark, drops)
    spend = revenue = 0.0
    below, expected = False, []
    for d, v in value.items():
        spend, revenue = spend + 3, revenue + v
        if revenue < spend and not below:
            expected.append(("c", DAY + timedelta(days=d), spend, revenue))
        below = revenue < spend
    found = [(r.campaign_id, r.date, float(r.spend_usd), float(r.revenue_usd))
             for r in closed.read_alerts(spark, folder).orderBy("date").collect()]
    assert found == expected and len(found) == 2


def test_no_events(spark):
    folder, _, seen = feed(spark, [([], [])])
    assert seen == [[]] and closed.read_alerts(spark, folder).count() == 0
    assert closed.late_cells(closed.read_closed(spark, folder), closed.read_closed(spark, folder)).count() == 0
