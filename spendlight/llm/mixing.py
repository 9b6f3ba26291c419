"""Mixing sources to target weights by systematic sampling. DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlight.llm.store import stored
from spendlight.operators.keys import with_dense_key

#: White space of the word count, weights by rank of the source, and the most copies of a text.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3

#: Expected copies are whole numbers of 1 / 2**UNIT_BITS, so prefix sums are exact in any order.
UNIT_BITS = 24


def word_count(text: Column) -> Column:
    """Words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Words to take from each source: columns source, source_size, target.

    ``sizes`` has source and size. Sources take the weights in turn by code
    point, null last, and share the sum of all sizes; a target stops at
    ``most`` times its source's size and the rest is shared again by weight.
    With a the words held by stopped sources and w the weight of the others,
    a source stops when most * size <= weight * (total - a) / w. Stopping only
    raises that level, so the set of stopped sources grows until it is final;
    every round reads one small row from the per-source table. A source of
    size 0 has target 0, an empty table no rows.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    keyed = totals.withColumn("_key", F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")))
    keyed = stored(keyed, "source-sizes")
    ranked = with_dense_key(keyed, "_rank", "_key")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = stored(ranked.withColumn("_weight", weight.cast("long")), "source-weights")

    exact = lambda c: F.col(c).cast("decimal(38,0)")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    stops, before = F.lit(False), -1
    while True:
        held, open_weight, stopped = ranked.agg(
            F.sum(F.when(stops, F.col("source_size") * most).otherwise(0)),
            F.sum(F.when(stops, 0).otherwise(F.col("_weight"))),
            F.count_if(stops),
        ).first()
        if stopped == before or not open_weight:
            break
        before, left = stopped, total - held
        level = (F.lit(left).cast("decimal(38,0)"), F.lit(open_weight).cast("decimal(38,0)"))
        stops = exact("source_size") * most * level[1] <= exact("_weight") * level[0]
    share = F.lit(0.0)
    if open_weight:
        share = (F.col("_weight") * F.lit(total - held).cast("long")).cast("double") / F.lit(float(open_weight))
    target = F.when(stops, (F.col("source_size") * most).cast("double")).otherwise(share)
    return ranked.select("source", "source_size", target.alias("target"))


def systematic_copies(
    df: DataFrame, group: str, order: list[str], rank_hash: str, expected_units: str, rows: int, seed: str
) -> DataFrame:
    """Add ``copies``: how often each row is emitted.

    Inside a group rows stand in the order of ``order`` and then of the hex
    text ``rank_hash``; each has ``expected_units`` / 2**UNIT_BITS expected
    copies. With one offset per group, a row is emitted once for each whole
    number that the running sum crosses on it. The sum is built in two levels:
    a group is cut into slices by ``order`` and, for many ``rows``, by leading
    digits of the hash; slices are summed apart and shifted by the sum of those
    before them. No task holds a whole group, and the cut doesn't change the
    result.
    """
    digits = max(0, math.ceil(math.log(max(rows, 1) / 20_000, 16)))
    slice_key = ["_group", *order, "_part"]
    sliced = df.withColumns(
        {
            "_group": F.when(F.col(group).isNull(), "1").otherwise(F.concat(F.lit("0"), group)),
            "_part": F.substring(rank_hash, 1, digits),
        }
    )
    keys, over = ", ".join(slice_key), ", ".join(slice_key[1:])
    starts = (
        sliced.groupBy(*slice_key)
        .agg(F.sum(expected_units).alias("_sum"))
        .withColumn("_start", F.expr(f"sum(_sum) over (partition by _group order by {over}) - _sum"))
        .drop("_sum")
    )
    # A group's offset: 24 bits of a digest, so that a rerun draws the same one.
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), "_group")), 1, UNIT_BITS // 4), 16, 10).cast("long")
    tie = ", ".join([rank_hash, *[c for c in ("_id", "_size") if c in df.columns]])
    running = f"sum({expected_units}) over (partition by {keys} order by {tie} rows unbounded preceding)"
    counted = (
        sliced.withColumn("_end", F.expr(running))
        .join(starts, slice_key)
        .withColumn("_end", F.col("_end") + F.col("_start") + offset)
    )
    crossed = F.shiftright(F.col("_end"), UNIT_BITS) - F.shiftright(F.col("_end") - F.col(expected_units), UNIT_BITS)
    return counted.withColumn("copies", crossed).drop("_end", "_start", "_group", "_part")


def mix(df: DataFrame, sizes: DataFrame, seed: str = "mix", most: int = MOST) -> DataFrame:
    """Add source_size, target and copies to rows that have _id, source and _size.

    ``sizes`` has the columns source and size of the same rows. Inside a source
    rows are ordered by size (eight steps per power of two), so that the words
    of the sample follow the target closely however uneven the texts are; ties
    follow a digest of the id. Rows without an id count as rows with an empty
    one, equal rows share their copies in any order, and a source of size 0 is
    not taken.
    """
    targets = source_targets(sizes, most=most).withColumnsRenamed({"source": "_source"})
    rows = sizes.count()
    shift = F.greatest(F.length(F.bin("_size")) - 4, F.lit(0))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # The table of sources may be of any length: it is joined, never broadcast by hint.
    with_units = (
        df.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left")
        .drop("_source")
        .withColumns(
            {
                "_units": F.floor(expected * 2**UNIT_BITS).cast("long"),
                "_bin": shift * 16 + F.expr("shiftright(_size, greatest(length(bin(_size)) - 4, 0))"),
                "_hash": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))),
            }
        )
    )
    out = systematic_copies(with_units, "source", ["_bin"], "_hash", "_units", rows, f"{seed}/")
    return out.drop("_units", "_bin", "_hash")


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies.

    Needs doc_id, text and source; other columns are not read. A null text has
    size 0. An empty table gives no rows.
    """
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    rows = sized.select(F.col("doc_id").alias("_id"), "source", F.col("size").alias("_size"))
    return mix(rows, sized.select("source", "size"), seed).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.col("copies")).alias("taken"),
        "copies",
    )


def emitted_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    A document taken twice is two equal rows. Columns may have any names: the
    row travels as one struct.
    """
    size = word_count(F.col("text"))
    sizes = stored(docs.select("source", size.alias("size")), "sizes")
    rows = docs.select(F.col("doc_id").alias("_id"), "source", size.alias("_size"), F.struct("*").alias("_row"))
    taken = mix(rows, sizes, seed).where("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def oracle() -> str:
    """The same mix as DuckDB SQL."""
    return r"""
    with sized as (
        select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
        from documents
    ), totals as (
        select source, sum(size)::bigint as source_size,
               row_number() over (order by source is null, source collate "C") as rn
        from sized group by source
    ), weighed as (
        select source, source_size, case (rn - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight from totals
    ), steps as (
        select *, coalesce(sum(3 * source_size) over w, 0)::hugeint as held,
               (sum(weight) over () - coalesce(sum(weight) over w, 0))::hugeint as open_weight,
               sum(source_size) over ()::hugeint as total
        from weighed
        window w as (order by 3.0 * source_size / weight, source rows between unbounded preceding and 1 preceding)
    ), level as (
        select (total - held) as num, open_weight as den from steps
        where 3 * source_size * open_weight > weight * (total - held)
        order by 3.0 * source_size / weight, source limit 1
    ), targets as (
        select source, source_size,
               case when num is null or 3::hugeint * source_size * den <= weight * num then (3 * source_size)::double
                    else (weight * num)::double / den::double end as target
        from weighed left join level on true
    ), placed as (
        select s.*, t.source_size, t.target,
               case when t.source_size > 0 then floor(t.target / t.source_size * 16777216)::bigint else 0 end as units,
               greatest(length(bin(s.size)) - 4, 0) * 16 + (s.size >> greatest(length(bin(s.size)) - 4, 0)) as size_bin,
               md5('mix:' || coalesce(s.doc_id::varchar, '')) as h,
               md5('mix/' || case when s.source is null then '1' else '0' || s.source end) as source_hash
        from sized s join targets t on s.source is not distinct from t.source
    ), summed as (
        select *, ('0x' || substr(source_hash, 1, 6))::bigint
               + sum(units) over (partition by source order by size_bin, h, doc_id, size rows unbounded preceding) as upto
        from placed
    )
    select doc_id, size, source_size, target, (size * copies)::bigint as taken, copies
    from (select *, ((upto::bigint >> 24) - ((upto::bigint - units) >> 24))::bigint as copies from summed)
    """
