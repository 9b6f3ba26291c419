import pytest
from shared import clashing_documents, no_documents, odd_documents, rows_of

from spendlight.llm import mixing


def filled(sizes, weights, most=3):
    """Share the total by weight, stop at most * size, share the rest again: the rule, step by step."""
    total, targets = sum(sizes), [0.0] * len(sizes)
    stopped = set()
    while True:
        left = total - sum(most * sizes[i] for i in stopped)
        open_ones = [i for i in range(len(sizes)) if i not in stopped]
        share = {i: left * weights[i] / sum(weights[j] for j in open_ones) for i in open_ones}
        over = {i for i in open_ones if share[i] >= most * sizes[i]}
        if not over:
            return [float(most * sizes[i]) if i in stopped else share[i] for i in range(len(sizes))]
        stopped |= over


@pytest.mark.parametrize("sizes", [[100, 1, 1, 50, 3], [10, 10, 10], [1, 1000, 1, 1, 1, 1, 1000], [5], [0, 7, 0]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    table = spark.createDataFrame(rows, "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(table).collect()}
    expected = filled(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert [found[f"s{i}"] for i in range(len(sizes))] == pytest.approx(expected)


def test_taken_words_follow_the_targets(spark):
    rows = [(i, "w " * (1 + i * i % 97), "big" if i % 3 else f"s{i % 9}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixed_documents(docs)
    assert all(r.taken <= 3 * r.size for r in found.collect())
    for r in found.groupBy("source_size", "target").agg({"taken": "sum"}).collect():
        assert r["sum(taken)"] == pytest.approx(r.target, rel=0.05)
    assert rows_of(found) == rows_of(mixing.mixed_documents(docs.repartition(7)))


def test_copies_do_not_depend_on_the_slices(spark):
    rows = [(f"{i % 2}", f"{i * 7919 % 65536:04x}", 3 * (1 << 21) + i, i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, h string, u long, o int")
    runs = [
        sorted((r.g, r.h, r.o, r.copies) for r in mixing.systematic_copies(df, "g", ["o"], "h", "u", n, "x").collect())
        for n in (1, 10**5, 10**7)
    ]
    assert runs[0] == runs[1] == runs[2]
    for g in "01":
        total = sum(r[2] for r in rows if r[0] == g) / (1 << mixing.UNIT_BITS)
        assert abs(sum(r[3] for r in runs[0] if r[0] == g) - total) <= 1


def test_odd_documents(spark):
    found = mixing.mixed_documents(odd_documents(spark)).collect()
    assert len(found) == 12
    assert {r.doc_id: r.size for r in found if r.doc_id in (2, 3, 5)} == {2: 0, 3: 0, 5: 0}
    assert mixing.mixed_documents(no_documents(spark)).collect() == []


def test_emitted_documents_keep_every_column(spark):
    docs = clashing_documents(spark)
    out = mixing.emitted_documents(docs)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.copies for r in mixing.mixed_documents(docs).collect() if r.doc_id in (6, 7, 9)}
    assert {d: sum(r.doc_id == d for r in out.collect()) for d in taken} == taken
    assert mixing.emitted_documents(no_documents(spark)).collect() == []
