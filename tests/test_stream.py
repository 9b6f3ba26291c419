from datetime import date, timedelta

from conftest import AD_EVENTS, CONVERSIONS

from spendlight.operators import star
from spendlight.session import scratch_dir
from spendlight.streaming import daily

DAY = date(2024, 1, 10)
COLUMNS = ["campaign_id", "date", "spend_usd", "impressions", "clicks", "orders", "revenue_usd", "new_customers"]


def batches(days):
    """Drops of events; later ones touch the days of earlier ones again."""
    for drop, shift in enumerate(days):
        day = DAY + timedelta(days=shift)
        yield (
            [(f"c{n % 3}", day, ["click", "impression"][n % 2], 0.00000125) for n in range(drop + 5)],
            [(f"c{n % 4}", day, 10.0 + drop, n % 2) for n in range(drop + 3)],
        )


def rows(df):
    return sorted(df.select(COLUMNS).collect())


def run(spark, days):
    """Feed the drops one per micro-batch; the folder and the batch result."""
    session = daily.streaming_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    ads_dir, sold_dir, folder = (scratch_dir(spark, n) for n in ("ads", "sold", "stream"))
    source = lambda path, ddl: session.readStream.schema(ddl).parquet(path)
    for ads, sold in batches(days):
        spark.createDataFrame(ads, AD_EVENTS).coalesce(1).write.mode("append").parquet(ads_dir)
        spark.createDataFrame(sold, CONVERSIONS).coalesce(1).write.mode("append").parquet(sold_dir)
        contributed = star.contributions(source(ads_dir, AD_EVENTS), source(sold_dir, CONVERSIONS))
        daily.start(contributed, folder).awaitTermination()
    whole = star.contributions(spark.read.parquet(ads_dir), spark.read.parquet(sold_dir))
    return folder, rows(star.daily_cells(whole).where("ad_rows > 0"))


def test_batches_out_of_order_add_up_to_the_batch_result(spark):
    """Rows twenty days late count like any other."""
    folder, expected = run(spark, [0, 20, 0, 7, 0])
    assert rows(daily.daily_metrics(spark, folder)) == expected
    deltas = spark.read.schema(daily.DELTAS).parquet(f"{folder}/deltas")
    assert deltas.select("batch_id").distinct().count() == 5

    # Running a batch again leaves the same table.
    again = spark.createDataFrame(
        [("c0", DAY, 1, 5, 1, 0, 0, 0, 0)],
        "campaign_id string, date date, ad_rows long, spend_units long, impressions long, clicks long, orders long,"
        " revenue_units long, new_customers long",
    )
    for _ in range(2):
        daily.add_delta(folder)(again, 99)
    found = {(r.campaign_id, r.date): r.impressions for r in rows(daily.daily_metrics(spark, folder))}
    before = {(r.campaign_id, r.date): r.impressions for r in expected}
    assert found == before | {("c0", DAY): before["c0", DAY] + 1}


def test_compaction_changes_no_result_and_shortens_the_read(spark):
    folder, expected = run(spark, [0, 1, 0, 2])
    daily.compact(spark, folder, 1)
    assert rows(daily.daily_metrics(spark, folder)) == expected
    daily.compact(spark, folder, 3)
    daily.compact(spark, folder, 2)
    parts, upto = daily._parts(spark, folder)
    assert upto == 3 and parts.where("batch_id > 3").count() == 0
    assert rows(daily.daily_metrics(spark, folder)) == expected


def test_no_events(spark):
    session = daily.streaming_session(spark)
    empty, folder = scratch_dir(spark, "empty"), scratch_dir(spark, "stream")
    spark.createDataFrame([], AD_EVENTS).write.parquet(f"{empty}/a")
    spark.createDataFrame([], CONVERSIONS).write.parquet(f"{empty}/c")
    source = lambda name, ddl: session.readStream.schema(ddl).parquet(f"{empty}/{name}")
    daily.start(star.contributions(source("a", AD_EVENTS), source("c", CONVERSIONS)), folder).awaitTermination()
    assert daily.daily_metrics(spark, folder).count() == 0
