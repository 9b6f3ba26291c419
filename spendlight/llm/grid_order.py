"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlight.llm.components import components
from spendlight.llm.store import stored

#: Vectors of a leaf of the sequence, of a run inside a leaf, and intervals that one interval splits into.
LEAF = 1024
RUN = 32
FAN = 32
#: Leaves of a part of the sequence, about.
PART = 16
#: Leading principal dimensions of the grid, and the rows they are fitted on at most.
GRID_DIMS = 16
FIT_ROWS = 4096
#: Room for rounding in the bounds; it only lets through more pairs, which are then compared exactly.
SLACK = 1e-6


def _usable(vector: Column) -> Column:
    doubles = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(sound & F.exists(doubles, lambda x: x != 0), F.lit(False))


def _directions(nodes: DataFrame, dims: int) -> dict[int, np.ndarray]:
    """Leading principal directions by vector length, fitted on a bounded sample drawn by hash.

    Any orthonormal directions keep distances from growing, so the sample
    decides how much is skipped and never what is found.
    """
    share = F.pmod(F.xxhash64("k1", "k2"), F.lit(1 << 30))
    total = nodes.count()
    drawn = nodes.where(share < int(min(1.0, FIT_ROWS / max(total, 1)) * (1 << 30))).select("vector").limit(FIT_ROWS)
    by_length: dict[int, list] = {}
    for row in drawn.collect():
        v = np.array(row["vector"], np.float64)
        by_length.setdefault(len(v), []).append(v / np.linalg.norm(v))
    return {n: np.linalg.svd(np.array(vs), full_matrices=False)[2][:dims] for n, vs in by_length.items()}


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in doubles."""
    return vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _placed(nodes: DataFrame, eps: float, dims: int) -> DataFrame:
    """Add the grid cell of a vector in the leading dimensions (cells) and its spot, 32-bit floats.

    A spot is the place of the unit vector in the leading dimensions and, last, the
    length of what they leave out. Spots are never further apart than the unit
    vectors, so what is too distant as spots is so as vectors.
    """
    directions = nodes.sparkSession.sparkContext.broadcast(_directions(nodes, dims))
    cell = max(eps, 1e-3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = np.zeros((len(batch), dims + 1))
            vectors, lengths = batch.column("vector"), batch.column("length").to_numpy()
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                raw = _matrix(vectors.take(pa.array(at)))
                unit = raw / np.abs(raw).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                axes = directions.value.get(length)
                if axes is None:  # no vector of this length in the sample: its first coordinates
                    axes = np.eye(min(dims, length), length)
                spots[at, : len(axes)] = unit @ axes.T
            spots[:, dims] = np.sqrt(np.maximum(0, 1 - (spots * spots).sum(axis=1)))
            cells = np.floor(spots[:, :dims] / cell).astype(np.int32)
            columns = [batch.column(c) for c in kept]
            columns.append(pa.array(list(cells), pa.list_(pa.int32())))
            columns.append(pa.array([s.tobytes() for s in spots.astype(np.float32)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "cells", "spot"])

    kept = ["node", "label", "length"]
    schema = T.StructType([nodes.schema[c] for c in kept]).add("cells", T.ArrayType(T.IntegerType())).add("spot", "binary")
    return nodes.select(*kept, "vector").mapInArrow(run, schema)


def _leaves(placed: DataFrame, dims: int) -> DataFrame:
    """Cut the vectors, in the order of label, length and cells, into leaves of LEAF at most.

    The sequence is range-partitioned; leaves are cut inside a part and at every
    change of label or length, and numbered by part and place, so their order is
    that of the sequence. A leaf carries spots only, no vectors.
    """
    parts = max(1, math.ceil(placed.count() / (PART * LEAF)))
    keys = ["label", "length", "cells", "node"]
    ordered = placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    size = LEAF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, kinds = TaskContext.get().partitionId(), 0, [], []

        def leaf() -> pa.RecordBatch:
            spots = b"".join(r["spot"] for r in held)
            points = np.frombuffer(spots, np.float32).reshape(len(held), -1).astype(np.float64)
            values = [held[0]["label"], held[0]["length"], [*points.min(axis=0)], [*points.max(axis=0)]]
            types = [*kinds, pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.binary()]
            values = [part, made, *values, [r["node"] for r in held], spots]
            columns = [pa.array([v], k) for v, k in zip(values, [pa.int64(), pa.int64(), *types])]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            kinds = [batch.schema.field(k).type for k in ("label", "length")]
            for row in batch.to_pylist():
                if held and (len(held) == size or any(row[k] != held[0][k] for k in ("label", "length"))):
                    yield leaf()
                    made, held = made + 1, []
                held.append(row)
        if held:
            yield leaf()

    names = ["part", "made", "label", "length", "lo", "hi", "nodes", "spots"]
    kind = placed.schema["label"].dataType.simpleString()
    schema = f"part long, made long, label {kind}, length int, lo array<double>, hi array<double>"
    schema += ", nodes array<long>, spots binary"
    return ordered.select("node", "label", "length", "spot").mapInArrow(run, schema)


def _near_leaves(leaves: DataFrame, eps: float, dims: int) -> DataFrame:
    """Pairs of leaves (a <= b) that may hold a pair within eps: columns a, b, places in the sequence.

    Starting with the whole sequence of a label against itself, pairs of intervals
    are split into FAN parts each, and pairs whose boxes of spots are further
    apart than eps are dropped with all that is in them. Places have gaps
    between parts, so that no leaf needs to know how many stand before it.
    """
    lo, hi = [f"lo{d}" for d in range(dims + 1)], [f"hi{d}" for d in range(dims + 1)]
    group = ["label", "length"]
    boxes = stored(
        leaves.select("place", *group, *[F.col(c[:2])[int(c[2:])].alias(c) for c in lo + hi]), "leaf-boxes"
    )
    last = boxes.agg(F.max("place")).first()[0]
    if last is None:
        return boxes.select(F.col("place").alias("a"), F.col("place").alias("b"))
    depth = 0
    while last >= FAN**depth:
        depth += 1
    pairs = boxes.select(*group).distinct().withColumns({"a": F.lit(0).cast("long"), "b": F.lit(0).cast("long")})
    for level in range(depth - 1, -1, -1):
        level_boxes = boxes.groupBy(*group, F.expr(f"place div {FAN**level}").alias("at")).agg(
            *[F.min(c).alias(c) for c in lo], *[F.max(c).alias(c) for c in hi]
        )

        def side(key: str, p: str) -> DataFrame:
            named = [F.col(c).alias(f"{p}_{c}") for c in lo + hi]
            return level_boxes.select(*group, F.expr(f"at div {FAN}").alias(key), F.col("at").alias(p), *named)  # noqa: B023

        gaps = [
            F.greatest(F.col(f"x_lo{d}") - F.col(f"y_hi{d}"), F.col(f"y_lo{d}") - F.col(f"x_hi{d}"), F.lit(0.0))
            for d in range(dims + 1)
        ]
        apart = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])
        joined = pairs.join(side("a", "x"), [*group, "a"]).join(side("b", "y"), [*group, "b"])
        near = joined.where((F.col("x") <= F.col("y")) & (apart <= eps * eps + SLACK))
        pairs = stored(near.select(*group, F.col("x").alias("a"), F.col("y").alias("b")), "near-intervals")
    return pairs.select("a", "b")


def _near_spots(x: np.ndarray, y: np.ndarray, near: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of x and of y have a spot of the other within the square root of ``near``.

    Runs of rows whose boxes are too distant are skipped.
    """
    x_starts, y_starts = np.arange(0, len(x), RUN), np.arange(0, len(y), RUN)
    x_lo, x_hi = np.minimum.reduceat(x, x_starts), np.maximum.reduceat(x, x_starts)
    y_lo, y_hi = np.minimum.reduceat(y, y_starts), np.maximum.reduceat(y, y_starts)
    x_hit, y_hit = np.zeros(len(x), bool), np.zeros(len(y), bool)
    y_run = np.arange(len(y)) // RUN
    y_squares = (y * y).sum(axis=1)
    for i, start in enumerate(x_starts):
        gaps = np.maximum(np.maximum(x_lo[i] - y_hi, y_lo - x_hi[i]), 0)
        at = np.flatnonzero(((gaps * gaps).sum(axis=1) <= near)[y_run])
        if not len(at):
            continue
        mine = x[start : start + RUN]
        within = (mine * mine).sum(axis=1)[:, None] + y_squares[at] - 2 * (mine @ y[at].T) <= near
        if same:
            within &= at != start + np.arange(len(mine))[:, None]
        x_hit[start : start + RUN] |= within.any(axis=1)
        y_hit[at] |= within.any(axis=0)
    return x_hit, y_hit


def _candidates(pairs: DataFrame, leaves: DataFrame, eps: float, dims: int) -> DataFrame:
    """Vectors of two near leaves that have a spot of the other leaf within eps: a, b, second (of b), node.

    At most one row per vector and pair of leaves, however many spots are near.
    """
    near = eps * eps + SLACK

    def side(key: str, p: str) -> DataFrame:
        held = [F.col(c).alias(f"{p}_{c}") for c in ("nodes", "spots")]
        return leaves.select(F.col("place").alias(key), *held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                a, b, x_ids, x_spots, y_ids, y_spots = (batch.column(c)[i].as_py() for c in names)
                flat = (np.frombuffer(s, np.float32).astype(np.float64) for s in (x_spots, y_spots))
                x, y = (spots.reshape(-1, dims + 1) for spots in flat)
                hits = _near_spots(x, y, near, a == b)
                for second, (ids, hit) in enumerate(zip((x_ids, y_ids), hits)):
                    found = np.array(ids, np.int64)[hit]
                    if len(found) and not (second and a == b):
                        ends = [pa.array([v] * len(found), t) for v, t in zip((a, b, bool(second)), kinds)]
                        yield pa.RecordBatch.from_arrays([*ends, pa.array(found)], names=["a", "b", "second", "node"])

    names = ["a", "b", "x_nodes", "x_spots", "y_nodes", "y_spots"]
    kinds = [pa.int64(), pa.int64(), pa.bool_()]
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return both.select(*names).mapInArrow(run, "a long, b long, second boolean, node long")


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest member of each member's group, by links among 0 .. n - 1."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        after = root.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _joined(candidates: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Compare the candidates of two leaves: node, links (copies of its partners here), root (a node it hangs on here).

    A pair of leaves has 2 * LEAF candidates at most and gives at most one row
    per vector, however many links there are between them.
    """

    def run(rows: pa.Table) -> pa.Table:
        ids, copies = (rows.column(c).to_numpy() for c in ("node", "copies"))
        vectors = _matrix(rows.column("vector").combine_chunks())
        second = rows.column("second").to_numpy().astype(bool)
        same = rows.column("a")[0] == rows.column("b")[0]
        left, right = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(~second), np.flatnonzero(second))
        x, y = vectors[left], vectors[right]
        norms = np.outer(np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1)))
        linked = (x @ y.T) / norms >= threshold
        if same:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(ids), np.int64)
        links[left] = linked @ copies[right]
        if not same:
            links[right] = copies[left] @ linked
        i_at, j_at = np.nonzero(linked)
        root = _roots(len(ids), left[i_at], right[j_at])
        used = np.flatnonzero(links)
        return pa.table({"node": ids[used], "links": links[used], "root": ids[root[used]]})

    held = candidates.join(nodes.select("node", "copies", "vector"), "node")
    return held.groupBy("a", "b").applyInArrow(run, "node long, links long, root long")


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    dims: int = GRID_DIMS,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors of the same label and length link if their cosine, in doubles, is at
    least ``threshold``. Null labels, null, empty and zero vectors and vectors
    with null or non-finite components link with nothing; they are their own
    component. Equal vectors are joined as one and counted as many, so a vector
    that a third of all rows hold costs one row. Ids may be null (never the
    smallest of a component) or repeat. Other columns are not read.
    """
    eps = math.sqrt(2 - 2 * threshold)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label"))
    usable = F.col("label").isNotNull() & _usable(F.col("vector"))
    # Two hashes of 64 bits stand for a vector and its label; equal ones are equal vectors.
    key = {
        "k1": F.when(usable, F.xxhash64("label", "vector")),
        "k2": F.when(usable, F.xxhash64(F.lit(1), "vector", "label")),
    }
    keyed = rows.withColumns(key)
    distinct = keyed.where("k1 is not null").groupBy("k1", "k2").agg(
        F.first("vector").alias("vector"),
        F.first("label").alias("label"),
        F.min("id").alias("least"),
        F.count("*").alias("copies"),
    )
    numbered = distinct.withColumns({"node": F.monotonically_increasing_id(), "length": F.size("vector")})
    nodes = stored(numbered, "vectors")
    cut = stored(_leaves(stored(_placed(nodes, eps, dims), "placed-vectors"), dims), "leaves")
    most, width = cut.agg(F.max("made")).first()[0] or 0, FAN
    while width <= most:
        width *= FAN
    leaves = cut.withColumn("place", F.col("part") * width + F.col("made"))
    near = _candidates(_near_leaves(leaves, eps, dims), leaves, eps, dims)
    found = stored(_joined(near, nodes, threshold), "vector-links")
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))

    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        nodes.select("node", "k1", "k2", "least", "copies")
        .join(counted, "node", "left")
        .join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    per_vector = known.join(least, "component").select(
        "k1", "k2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    component = F.coalesce("component_id", "id")
    return (
        keyed.select("id", "k1", "k2")
        .join(per_vector, ["k1", "k2"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
    )


def oracle(threshold: float = 0.98) -> str:
    """The same result as DuckDB SQL, by comparing all pairs of a label."""
    return f"""
    with recursive v as (
        select row_number() over () as r, vec_id, label, embedding::double[] as e,
               label is not null and embedding is not null and len(embedding) > 0
               and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
               and len(list_filter(embedding, lambda x: x <> 0)) > 0 as ok
        from embeddings
    ), links as (
        select a.r as x, b.r as y from v a join v b on a.label = b.label and a.r <> b.r and len(a.e) = len(b.e)
        where a.ok and b.ok and list_cosine_similarity(a.e, b.e) >= {threshold}
    ), reach(x, y) as (
        select x, y from links union select reach.x, links.y from reach join links on reach.y = links.x
    ), counted as (select x as r, count(*) as n from links group by x),
    near as (select x, y from reach union select r, r from v),
    least as (select x as r, min(vec_id) as m from near join v on v.r = y group by x)
    select vec_id, coalesce(n, 0)::bigint as n_links, m as component_id, vec_id is not distinct from m as kept
    from v left join counted using (r) join least using (r)
    """
