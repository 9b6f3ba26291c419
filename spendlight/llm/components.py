"""Connected components of a link table that may be of any size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlight.llm.store import stored

#: Links that one task may finish: some 30 MB there. More are contracted by star rounds.
FEW = 1 << 18


def components(links: DataFrame, few: int = FEW) -> DataFrame:
    """Columns node, component: the smallest node reachable by the links (columns a, b), for every node of a link.

    Alternating large and small stars: every node hangs its larger neighbours,
    then its smaller ones and itself, on the smallest node it knows, until all
    are stars or no more than ``few`` links are left, which are counted. Those few are
    finished in one task. Each round is a grouping with a map-side step and a
    join on the node, where Spark splits a node of very many links. Each round
    is written to the shared folder, and only counts come back.
    """
    edges = stored(_directed(links.select("a", "b")), "links")
    while edges.count() > few and not _is_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "stars")
    # As stars, or few: then links are joined in one task.
    stars = edges if edges.count() > few else _finished(edges)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def merged_components(groups: DataFrame, links: DataFrame, few: int = FEW) -> DataFrame:
    """Components of earlier ones (node, component) and further links: the links between components are joined."""
    of = lambda end: groups.select(F.col("node").alias(end), F.col("component").alias(f"{end}_of"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = ends.select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b"))
    joined = stored(components(between, few), "joined")
    renamed = joined.select(F.col("node").alias("component"), F.col("component").alias("joined"))
    moved = groups.join(renamed, "component", "left")
    old = moved.select("node", F.coalesce("joined", "component").alias("component"))
    # Nodes that were in no group before.
    return old.unionByName(joined.join(groups.select("node"), "node", "left_anti"))


def _finished(edges: DataFrame) -> DataFrame:
    """Every node but the smallest with the smallest of its component, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(node: int) -> int:
            top = node
            while above.setdefault(top, top) != top:
                top = above[top]
            while above[node] != top:
                above[node], node = top, above[node]
            return top

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                above[max(a, b)] = min(a, b)
        stars = [(node, root(node)) for node in above if root(node) != node]
        for i in range(0, len(stars), 10_000):
            columns = zip(*stars[i : i + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return stored(edges.select("a", "b").coalesce(1).mapInArrow(run, "a long, b long"), "finished")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node is either the center of its links or has one link, to a center."""
    upper = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    lower = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = upper.unionByName(lower).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up + down > 1").isEmpty()


def _directed(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    ends = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ends.distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    least = nearest.select("node", F.least("node", "m").alias("m"))
    # The larger neighbours of b are the ends a of its links (a > b).
    return edges.join(least, edges.b == least.node).select("a", F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node itself, to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    moved = edges.join(least, edges.a == least.node).select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = least.select(F.col("node").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").unionByName(kept).distinct()
