"""Cutting rows into slices of the id order without ordering them in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a slice, about.
SLICE = 4096


def id_slices(docs: DataFrame) -> tuple[Column, int]:
    """The slice (0, 1, ..) of a row by its doc_id, a whole number, and how many slices there are.

    Slices are cut at quantiles of all ids, so they hold about SLICE rows each
    whatever the ids are, and stand in the order of the ids; equal ids share one
    and rows without an id have the last. There are 65,536 at most: beyond that
    slices grow. The cut is a constant of the plan, looked up in two levels.
    """
    n = docs.count()
    slices = min(max(1, math.ceil(n / SLICE)), 1 << 16)
    cuts = []
    if slices > 1:
        shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
        cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10 * slices)).first()[0] or []))
    wide = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + wide] for i in range(0, len(cuts), wide)]

    def longs(xs: list[int]) -> str:
        return f"array({', '.join(f'{x}L' for x in xs)})" if xs else "cast(array() as array<bigint>)"

    heads, fine = longs([b[0] for b in blocks]), f"array({', '.join(map(longs, blocks)) or longs([])})"
    block = f"size(filter({heads}, c -> c <= d))"
    expr = (
        f"element_at(transform(transform(array(doc_id), d -> named_struct('d', d, 'b', {block})),"
        f" s -> if(s.d is null, {len(cuts) + 1}, if(s.b = 0, 0,"
        f" (s.b - 1) * {wide} + size(filter(get({fine}, s.b - 1), c -> c <= s.d))))), 1)"
    )
    return F.expr(expr), len(cuts) + 2


