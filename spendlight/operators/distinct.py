"""Exact distinct counts that merge: bitmaps of keys per day, joined for any period without the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_bitmaps(fact: DataFrame, *by: str, key: str = "campaign_key") -> DataFrame:
    """Columns ``by``, bucket, bitmap: the keys of each group as bits, 32,768 keys a bucket.

    A grouping with a map-side step: what is shuffled is 4 KB per group and bucket
    of keys, however many rows there are. Keys are whole and positive, and dense
    ones give few buckets. Rows without a key count for nothing.
    """
    placed = fact.where(F.col(key).isNotNull())
    bucket = F.bitmap_bucket_number(key).alias("bucket")
    return placed.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bitmap"))


def distinct_of(bitmaps: DataFrame, *by: str | Column) -> DataFrame:
    """The number of different keys per ``by`` over bitmaps of finer groups: their bits are joined, and counted."""
    joined = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    names = [c for c in joined.columns if c not in ("bucket", "bitmap")]
    return joined.groupBy(*names).agg(F.sum(F.bitmap_count("bitmap")).alias("campaigns"))


def campaigns_by_period(bitmaps: DataFrame) -> DataFrame:
    """period, first_day, channel, campaigns: days, weeks, months and all time, from daily bitmaps (date, channel)."""
    found = []
    starts = {
        "day": F.col("date"),
        "week": F.date_trunc("week", "date").cast("date"),
        "month": F.date_trunc("month", "date").cast("date"),
        "all": F.lit(None).cast("date"),
    }
    for period, start in starts.items():
        counted = distinct_of(bitmaps.withColumn("first_day", start), "first_day", "channel")
        found.append(counted.select(F.lit(period).alias("period"), "first_day", "channel", "campaigns"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
