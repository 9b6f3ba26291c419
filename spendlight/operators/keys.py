"""Dense surrogate keys without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_stable_key(df: DataFrame, key: str, order_by: str, known: DataFrame | None) -> DataFrame:
    """Give the rows of a unique column the keys in ``known`` (order_by, key); new ones are numbered from there on.

    ``known`` only ever grows: a value keeps its key when others come before it
    or go. New values are numbered in their order from the largest known key.
    """
    if known is None:
        return with_dense_key(df, key, order_by)
    known = known.select(order_by, key)
    top = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("top"))
    fresh = with_dense_key(df.join(known, order_by, "left_anti"), "_n", order_by)
    fresh = fresh.withColumn(key, (F.col("_n") + top.scalar()).cast(known.schema[key].dataType)).drop("_n")
    return df.join(known, order_by).unionByName(fresh)


def with_dense_key(df: DataFrame, key: str, order_by: str, slices: int | None = None) -> DataFrame:
    """Number the rows 1..N in the order of a unique column.

    The value range is cut into slices at up to ``slices`` values picked by
    hash (default: as many as the session has shuffle partitions), rows are
    numbered inside their slice, and each slice starts where the ones before it
    end. Cuts and slice sizes are at most ``slices`` + 1
    values, read as scalar subqueries; the rows themselves are shuffled once,
    by slice. The cuts depend on the values alone, so a task that is run again
    gives the same keys.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = (
        df.select(order_by)
        .orderBy(F.expr(f"xxhash64({order_by})"), order_by)
        .limit(slices)
        .selectExpr(f"sort_array(collect_list({order_by})) as cuts")
    )
    # The value is bound once per row (v), or its expression would be worked out
    # again for every cut.
    slice_of = f"element_at(transform(array({order_by}), v -> size(filter(_cuts, cut -> cut <= v))), 1)"
    sliced = (
        df.withColumn("_cuts", cuts.scalar())
        .withColumn("_slice", F.expr(slice_of))
        .drop("_cuts")
    )
    sizes = (
        sliced.groupBy("_slice")
        .agg(F.expr("count(*) as n"))
        .selectExpr("collect_list(named_struct('slice', _slice, 'n', n)) as sizes")
    )
    starts = sizes.selectExpr(
        f"transform(sequence(0, {slices}), i -> aggregate(sizes, 0L, (sum, s) -> sum + if(s.slice < i, s.n, 0L)))"
    )
    return (
        sliced.withColumn("_start", F.element_at(starts.scalar(), F.expr("_slice + 1")))
        .withColumn(key, F.expr(f"_start + row_number() over (partition by _slice order by {order_by})"))
        .drop("_slice", "_start")
    )
