"""Raw CSV tables through the whole job, and the sinks on their own."""

from datetime import date, timedelta

import pytest
from conftest import plan_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spendlight.functions import masked_key
from spendlight.operators import marts, periods, star
from spendlight.operators.keys import with_stable_key
from spendlight.plans import build, mart_sql, versions
from spendlight.schemas import RAW, STAR
from spendlight.session import scratch_dir
from spendlight.sources import catalog, files

FIRST = date(2026, 1, 1)
DAYS = [FIRST + timedelta(days=i) for i in range(10)]


def raw_rows():
    campaigns = [
        (f"camp_{i}", f"Campaign {i}", "adv_001", ["Meta", "Google"][i % 2], "performance", "active",
         FIRST, DAYS[-1], 500)
        for i in range(4)
    ]
    days = [(d, d.year, d.month, d.strftime("%B"), d.day, d.weekday(), d.strftime("%A"), int(d.weekday() > 4), 1,
             d.isocalendar()[1]) for d in DAYS]
    events = [
        (f"ev_{n}", DAYS[n % 10], f"camp_{n % 4}", ["Meta", "Google"][n % 2], ["impression", "click"][n % 3 == 0],
         f"u{n % 7}", "mobile", "US", 0.01 * (n % 50), 0.0, 0)
        for n in range(400)
    ]
    sold = [
        (f"cv_{n}", DAYS[n % 10], f"camp_{n % 4}", ["Meta", "Google"][n % 2], f"u{n % 7}", "purchase", 10.5, n % 2)
        for n in range(40)
    ]
    users = [(f"u{n}", "25-34", "female", ["US", "DE"][n % 2], "organic", 10.0 * n) for n in range(7)]
    return {
        "dim_campaigns": campaigns, "dim_time": days, "dim_users": users, "fact_ad_events": events,
        "fact_conversions": sold,
    }


def write_raw(spark, rows):
    raw = scratch_dir(spark, "raw")
    for name, values in rows.items():
        files.write_csv(spark.createDataFrame(values, RAW[name]), f"{raw}/{name}.csv")
    return raw


@pytest.fixture(scope="module")
def done(spark):
    output = scratch_dir(spark, "out")
    report = build.run(spark, write_raw(spark, raw_rows()), output, "spendlight_test", "salt", version="v1").collect()
    return f"{output}/v1", report


def test_every_check_passes(done):
    assert len(done[1]) > 20
    assert [r for r in done[1] if r.n_failed] == []


def test_outputs_exist_and_hold_all_rows(spark, done):
    output, _ = done
    tables = build.read_star(spark, output)
    assert {name: df.count() for name, df in tables.items()} == {
        "dim_date": 10, "dim_campaign": 4, "fact_campaign_daily": 20,
    }
    for name, schema in STAR.items():
        stored = {f.name: f.dataType for f in spark.read.parquet(f"{output}/{name}").schema}
        assert stored == {f.name: f.dataType for f in schema}
    fact = tables["fact_campaign_daily"].selectExpr("sum(spend_usd)", "sum(orders)", "sum(revenue_usd)").first()
    assert [float(v) for v in fact] == [98.0, 40.0, 420.0]


def test_marts_can_be_loaded_by_name(spark, done):
    loaded = catalog.load_tables(spark, "spendlight_test")
    assert {name: df.count() for name, df in loaded.items()} == {
        "mart_channel_summary": 2, "mart_campaign_summary": 4, "mart_monthly_summary": 2, "mart_campaign_daily": 20,
    }
    assert set(catalog.load_tables(spark, "spendlight_test", "dim_*")) == {"dim_date", "dim_campaign", "dim_users"}


def test_small_marts_are_one_csv_part(spark, done):
    path = f"{done[0]}/csv/mart_channel_summary"
    assert len(spark.read.option("header", True).csv(path).inputFiles()) == 1
    assert spark.read.option("header", True).csv(path).count() == 2


def test_sql_marts_on_the_catalog(spark, done):
    output, _ = done
    build.run_sql_marts(spark, "spendlight_test", output)
    for name in mart_sql.MARTS:
        ours = spark.table(f"spendlight_test.{name}")
        theirs = spark.read.parquet(f"{output}/sql/{name}").select(ours.columns)
        assert sorted(theirs.collect()) == sorted(ours.collect())


def test_masked_users_join_masked_events(spark, done):
    users = spark.table("spendlight_test.dim_users")
    assert users.where("user_id rlike '^[0-9a-f]{32}$'").count() == 7
    rows = raw_rows()
    ads = masked_key(spark.createDataFrame(rows["fact_ad_events"], RAW["fact_ad_events"]), "salt")
    sold = masked_key(spark.createDataFrame(rows["fact_conversions"], RAW["fact_conversions"]), "salt")
    assert ads.join(users, "user_id", "left_anti").count() == 0
    places = {r.geo: r.orders for r in periods.roas_by_geo(ads, sold, users).collect()}
    assert places == {"US": sum(n % 7 % 2 == 0 for n in range(40)), "DE": sum(n % 7 % 2 for n in range(40))}
    traffic = periods.traffic_by_geo(ads).select("geo", "impressions", "clicks")
    assert [tuple(r) for r in traffic.collect()] == [("US", 266, 134)]


def test_a_failed_run_leaves_the_published_tables(spark, monkeypatch):
    output, raw = scratch_dir(spark, "out"), write_raw(spark, raw_rows())
    build.run(spark, raw, output, "spendlight_safe", "salt", version="v1")
    before = sorted(spark.table("spendlight_safe.mart_channel_summary").collect())

    def stop(*args):
        raise RuntimeError("lost")

    fewer = raw_rows()
    fewer["fact_ad_events"] = fewer["fact_ad_events"][:100]
    raw = write_raw(spark, fewer)
    for step in ("write_marts", "write_days"):
        with monkeypatch.context() as patch:
            patch.setattr(build, step, stop)
            with pytest.raises(RuntimeError):
                build.run(spark, raw, output, "spendlight_safe", "salt", version=f"failed_{step}")
        assert sorted(spark.table("spendlight_safe.mart_channel_summary").collect()) == before
    build.run(spark, raw, output, "spendlight_safe", "salt", version="v2")
    after = spark.table("spendlight_safe.mart_channel_summary").selectExpr("sum(total_impressions + total_clicks)")
    assert after.first()[0] == 100


def test_a_run_over_some_dates_takes_the_others_over(spark):
    output, rows = scratch_dir(spark, "out"), raw_rows()
    build.run(spark, write_raw(spark, rows), output, "spendlight_dates", "salt", version="v1")
    clicks = lambda df: {r.date: r.n for r in df.groupBy("date").agg(F.sum("clicks").alias("n")).collect()}
    old = clicks(spark.table("spendlight_dates.fact_campaign_daily"))
    late = ("ev_late", DAYS[3], "camp_3", "Google", "click", "u1", "mobile", "US", 1.0, 0.0, 0)
    # A new campaign sorts first, and yet moves no key.
    first = ("camp_", "Campaign x", "adv_001", "Meta", "performance", "active", FIRST, DAYS[-1], 500)
    rows["dim_campaigns"].append(first)
    rows["fact_ad_events"] = [r for r in rows["fact_ad_events"] if r[1] == DAYS[3]] + [late]
    day = ("2026-01-04", "2026-01-04")
    report = build.run(spark, write_raw(spark, rows), output, "spendlight_dates", "salt", dates=day, version="v2")
    assert [r for r in report.collect() if r.n_failed] == []
    fact = spark.table("spendlight_dates.fact_campaign_daily")
    assert clicks(fact) == old | {DAYS[3]: old[DAYS[3]] + 1}
    names = spark.table("spendlight_dates.dim_campaign").select("campaign_key", "campaign_id")
    named = fact.join(names, "campaign_key")
    assert named.select("campaign_id").distinct().count() == 4 and named.count() == fact.count()
    keys = {r.campaign_id: r.campaign_key for r in names.collect()}
    assert keys == {"camp_0": 1, "camp_1": 2, "camp_2": 3, "camp_3": 4, "camp_": 5}


def day_files(spark, folder):
    return sorted(p.rsplit("/", 1)[1] for p in files.children(spark, folder) if "date=" in p)


def test_a_run_over_a_day_writes_that_day_alone(spark):
    output, rows, name = scratch_dir(spark, "out"), raw_rows(), "spendlight_days"
    build.run(spark, write_raw(spark, rows), output, name, "salt", version="v1")
    reader = spark.table(f"{name}.fact_campaign_daily")
    before = sorted(reader.collect())
    rows["fact_ad_events"] = [r for r in rows["fact_ad_events"] if r[1] == DAYS[3]][:5]
    rows["fact_conversions"] = []
    day = ("2026-01-04", "2026-01-04")
    build.run(spark, write_raw(spark, rows), output, name, "salt", dates=day, version="v2")
    for table in build.BY_DATE:
        assert day_files(spark, f"{output}/v1/{table}") == [f"date={d}" for d in DAYS]
        assert day_files(spark, f"{output}/v2/{table}") == ["date=2026-01-04"]
        assert spark.table(f"{name}.{table}").count() == len(before)
    used = spark.table(f"{name}.fact_campaign_daily").inputFiles()
    assert sum("/v1/" in f for f in used) and sum("/v2/" in f for f in used) == 1
    pruned = spark.table(f"{name}.fact_campaign_daily").where("date = date'2026-01-04'")
    assert all("/v2/" in f for f in pruned.inputFiles()) or "PartitionFilters: [isnotnull(date" in plan_of(pruned)
    # A reader of the old version goes on.
    assert sorted(reader.collect()) == before
    assert sorted(spark.table(f"{name}.fact_campaign_daily__v1").collect()) == before
    mart = spark.table(f"{name}.mart_channel_summary").selectExpr("sum(total_impressions + total_clicks)")
    assert mart.first()[0] == 360 + 5
    # A day that lost all its rows is gone.
    rows["fact_ad_events"] = []
    build.run(spark, write_raw(spark, rows), output, name, "salt", dates=day, version="v3")
    assert spark.table(f"{name}.fact_campaign_daily").where("date = date'2026-01-04'").count() == 0
    assert spark.table(f"{name}.fact_campaign_daily").select("date").distinct().count() == 9


def test_versions_expire_but_for_the_days_still_in_use(spark):
    output, rows, name = scratch_dir(spark, "out"), raw_rows(), "spendlight_expire"
    raw = write_raw(spark, rows)
    build.run(spark, raw, output, name, "salt", version="v1")
    for i, version in enumerate(("v2", "v3", "v4")):
        day = DAYS[i].isoformat()
        build.run(spark, raw, output, name, "salt", dates=(day, day), version=version)
    before = sorted(spark.table(f"{name}.fact_campaign_daily").collect())
    assert sorted(versions.expire(spark, name, output, keep=1)) == ["v1", "v2", "v3"]
    assert sorted(spark.table(f"{name}.fact_campaign_daily").collect()) == before
    assert day_files(spark, f"{output}/v1/fact_campaign_daily") == [f"date={d}" for d in DAYS[3:]]
    assert not files.children(spark, f"{output}/v1/dim_campaign") and files.children(spark, f"{output}/v4/dim_campaign")
    assert not spark.catalog.tableExists(f"{name}.fact_campaign_daily__v2")
    assert versions.expire(spark, name, output, keep=1) == []
    build.run(spark, raw, output, name, "salt", version="v5")
    assert versions.expire(spark, name, output, keep=1) == ["v4"]
    assert sorted(spark.table(f"{name}.fact_campaign_daily").collect()) == before


def test_keys_stay_when_campaigns_come_and_go(spark):
    table = lambda ids: spark.createDataFrame([(i,) for i in ids], "campaign_id string")
    known, seen = None, {}
    for ids in (["b", "d"], ["a", "b", "c", "d"], ["c", "e"], ["a", "b", "d", "0"], []):
        dim = with_stable_key(table(ids), "campaign_key", "campaign_id", known)
        now = {r.campaign_id: r.campaign_key for r in dim.collect()}
        assert sorted(now) == sorted(ids)
        assert all(seen.get(i, k) == k for i, k in now.items())
        seen |= now
        rows = [(r.campaign_id, r.campaign_key) for r in star.campaign_keys(dim, known).collect()]
        known = spark.createDataFrame(rows, "campaign_id string, campaign_key long")
        assert dict(rows) == seen
    assert seen == {"b": 1, "d": 2, "a": 3, "c": 4, "e": 5, "0": 6}


def test_an_empty_salt_is_refused(spark):
    with pytest.raises(ValueError):
        build.run(spark, "nowhere", "nowhere", "nowhere", "")


def test_long_exports_are_refused(spark):
    with pytest.raises(ValueError):
        files.export_csv(spark.range(11), scratch_dir(spark, "csv"), most=10)


def test_nothing_is_broadcast_by_estimate(spark):
    small = spark.range(5).selectExpr("id as k")
    assert "BroadcastHashJoin" not in plan_of(spark.range(5).selectExpr("id as k").join(small, "k"))


def test_date_filter_prunes_folders(spark, done):
    fact = files.read_parquet(spark, f"{done[0]}/fact_campaign_daily")
    pruned = fact.where("date between date'2026-01-02' and date'2026-01-03'")
    assert "PartitionFilters: [isnotnull(date" in plan_of(pruned)
    assert pruned.count() == 4
    by_name = spark.table("spendlight_test.fact_campaign_daily").where("date = date'2026-01-02'")
    assert "date" in plan_of(by_name).split("PartitionFilters:")[1][:60]
    assert by_name.count() == 2


def test_rewriting_a_date_keeps_the_others(spark):
    path = scratch_dir(spark, "by-date")
    rows = lambda values: spark.createDataFrame(values, "channel string, n int, date date")
    files.write_by_date(rows([("a", 1, DAYS[0]), ("b", 2, DAYS[0]), ("a", 3, DAYS[1])]), path)
    files.write_by_date(rows([("c", 9, DAYS[1])]), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("channel", "n", "date").collect()) == [
        ("a", 1, DAYS[0]), ("b", 2, DAYS[0]), ("c", 9, DAYS[1]),
    ]
    files.write_by_date(rows([("d", 4, DAYS[2])]), path, whole=True)
    assert [tuple(r) for r in spark.read.parquet(path).select("channel", "n", "date").collect()] == [("d", 4, DAYS[2])]
    assert all(".zstd.parquet" in name for name in spark.read.parquet(path).inputFiles())


def test_csv_that_does_not_fit_the_schema_is_refused(spark):
    path = scratch_dir(spark, "bad-csv")
    spark.createDataFrame([("x", "not a day")], "campaign_id string, event_date string").coalesce(1).write.option(
        "header", True
    ).csv(path)
    schema = spark.createDataFrame([], "campaign_id string, event_date date").schema
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_csv(spark, path, schema).collect()
    swapped = spark.createDataFrame([], "event_date date, campaign_id string").schema
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_csv(spark, path, swapped).collect()


def test_paths_are_any_uri(spark):
    uri = f"file://{scratch_dir(spark, 'uri')}"
    rows = spark.createDataFrame([("a", 1, DAYS[0])], "channel string, n int, date date")
    files.write_csv(rows, f"{uri}/csv")
    files.write_by_date(rows, f"{uri}/days")
    assert files.read_csv(spark, f"{uri}/csv", rows.schema).collect() == rows.collect()
    assert files.read_parquet(spark, f"{uri}/days").select(rows.columns).collect() == rows.collect()


def test_malformed_rows_are_counted(spark):
    path = scratch_dir(spark, "bad-csv")
    rows = [("x", "not a day"), ("y", "2026-01-02"), ("z", None), ("w", "2026-13-01")]
    spark.createDataFrame(rows, "campaign_id string, event_date string").write.option("header", True).csv(path)
    schema = spark.createDataFrame([], "campaign_id string, event_date date").schema
    found = files.malformed_rows(spark, path, schema, "ads")
    assert [tuple(r) for r in found.collect()] == [("malformed:ads", 4, 2)]


def test_existing_table_is_kept_unless_replaced(spark, done):
    path = scratch_dir(spark, "other")
    mart = marts.campaign_daily(build.read_star(spark, done[0])["fact_campaign_daily"]).limit(1)
    files.write_parquet(mart, path)
    catalog.create_database(spark, "spendlight_keep", scratch_dir(spark, "db"))
    register = lambda place, **kw: catalog.register_parquet(
        spark, "spendlight_keep", "t", place, mart.schema, **kw
    )
    register(path)
    register(scratch_dir(spark, "nowhere"))
    assert spark.table("spendlight_keep.t").count() == 1
    register(scratch_dir(spark, "nowhere"), replace=True)
    assert spark.table("spendlight_keep.t").count() == 0


def test_scratch_follows_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path != scratch_dir(spark, "x")
    if base:
        assert path.startswith(base)
