import numpy as np
import pytest
from pyspark.sql import functions as F
from shared import rows_of

from spendlight.llm import grid_order

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    ok = [r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1]) for r in rows]
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(np.float32(rows[k][1]), float) for k in (i, j))
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    component = [least.get(find(i)) for i in range(n)]
    return sorted(((r[0], links[i], component[i], r[0] == component[i]) for i, r in enumerate(rows)), key=repr)


def vectors(n=700, dims=12, labels=3):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, dims))
    rows = []
    for i in range(n):
        v = centers[rng.integers(40)] + rng.normal(size=dims) * rng.choice([0.02, 0.15, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.uniform(0.1, 10)], int(rng.integers(labels))))
    rows += [(n + i, rows[5][1], rows[5][2]) for i in range(40)]
    return rows


@pytest.mark.parametrize("leaf, fan", [(128, 8), (16, 2)])
def test_links_are_those_of_all_pairs(spark, monkeypatch, leaf, fan):
    monkeypatch.setattr(grid_order, "LEAF", leaf)
    monkeypatch.setattr(grid_order, "FAN", fan)
    rows = vectors()
    found = grid_order.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert rows_of(found) == brute(rows)


def test_distant_blocks_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(grid_order, "LEAF", 16)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=2)], 0) for i in range(800)]
    pairs = []
    found = grid_order._near_leaves
    monkeypatch.setattr(grid_order, "_near_leaves", lambda *a: pairs.append(found(*a)) or pairs[-1])
    assert rows_of(grid_order.near_vectors(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert pairs[0].count() < 50 * 51 / 2 / 3


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [], 0),
        (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (11, [1.0, 0.0, 0.0], 0),
        (12, [-1.0, 0.0], 0), (None, [1.0, 0.0], 0), (None, None, None), (13, [1.0, 0.01], 0), (13, [1.0, 0.01], 0),
        (14, [5.0], 2), (15, [7.0], 2),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = rows_of(grid_order.near_vectors(docs))
    expected = [(*r[:3], r[0] == r[2]) for r in brute([r for r in rows])]
    assert found == sorted(expected, key=repr)
    extra = ["id", "k1", "node", "vector", "links", "length", "a", "b", "leaf", "component", "copies", "least"]
    clashing = docs.withColumns({c: F.lit("x") for c in extra})
    assert rows_of(grid_order.near_vectors(clashing)) == found
    assert grid_order.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
