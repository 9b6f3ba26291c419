import random
from datetime import date, timedelta

from conftest import plan_of

from spendlight.operators import distinct


def test_bitmaps_merge_to_exact_counts(spark):
    draw = random.Random(7)
    first = date(2024, 1, 28)
    key = lambda: draw.choice([1, 32_768, 32_769, draw.randint(1, 99_999)])
    rows = [(first + timedelta(days=draw.randint(0, 20)), draw.choice("ab"), key()) for _ in range(2000)]
    rows += [(first, "a", None), (first, None, 5)]
    fact = spark.createDataFrame(rows, "date date, channel string, campaign_key long")
    bitmaps = distinct.key_bitmaps(fact, "date", "channel")
    found = {(r.period, r.first_day, r.channel): r.campaigns for r in distinct.campaigns_by_period(bitmaps).collect()}
    starts = {"day": lambda d: d, "week": lambda d: d - timedelta(days=d.weekday()), "month": lambda d: d.replace(day=1),
              "all": lambda d: None}
    expected = {}
    for period, start in starts.items():
        for day, channel, key in rows:
            if key is not None:
                expected.setdefault((period, start(day), channel), set()).add(key)
    assert found == {k: len(v) for k, v in expected.items()}
    plan = plan_of(distinct.distinct_of(bitmaps, "channel"))
    assert "bitmap_or_agg" in plan


def test_no_rows(spark):
    fact = spark.createDataFrame([], "date date, channel string, campaign_key long")
    assert distinct.campaigns_by_period(distinct.key_bitmaps(fact, "date", "channel")).collect() == []
