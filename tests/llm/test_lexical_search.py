import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from shared import clashing_documents, no_documents, odd_documents

from spendlight.llm import lexical_search as search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_force(docs, items, best=10):
    """Scores of all documents, straight from the rule."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, c), size in zip(counted, sizes):
            score = 0
            for t in plain_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * size * n) // total
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:best], 1)]
    return sorted(out, key=repr)


def found(docs, items):
    return sorted(map(tuple, search.ranked(docs, items).collect()), key=repr)


def drawn(seed, rows):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(draw.choices(words, weights, k=draw.randint(0, 60)))) for i in range(rows)], draw


@pytest.mark.parametrize("docs_a_shard, block, window", [(1 << 14, 128, 1 << 14), (97, 8, 64), (400, 4, 16)])
def test_equals_brute_force(spark, monkeypatch, docs_a_shard, block, window):
    rows, draw = drawn(11, 1500)
    rows += [(2000 + i, rows[7][1]) for i in range(400)]
    items = [(i, " ".join(draw.choice(rows)[1].split()[: draw.randint(0, 30)])) for i in range(25)]
    items += [(100, "nothing known here"), (101, ""), (102, None), (103, "w0 W0 w1,w1;w399")]
    for name, value in (("SHARD_DOCS", docs_a_shard), ("BLOCK", block), ("WINDOW", window)):
        monkeypatch.setattr(search, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs, spark.createDataFrame(items, ITEMS)) == brute_force(rows, items)


def test_queries_in_parts(spark, monkeypatch):
    monkeypatch.setattr(search, "VOCABULARY", 20)
    rows, draw = drawn(4, 200)
    items = [(i, draw.choice(rows)[1]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, spark.createDataFrame(items, ITEMS)) == brute_force(rows, items)


def test_blocks_are_packed_and_opened_again():
    draw = random.Random(2)
    for _ in range(200):
        n = draw.randint(1, 128)
        places = np.cumsum([draw.choice((1, 3, 200, 70_000)) for _ in range(n)])
        tfs = np.array([draw.choice((1, 2, 128, 129, 1 << 20)) for _ in range(n)])
        a, b = search.unpacked(search.packed(places, tfs), int(places[0]))
        assert a.tolist() == places.tolist() and b.tolist() == tfs.tolist()


def test_blocks_stay_closed():
    """A rare term decides: most blocks of the common terms are never opened."""
    n, draw = 16_000, random.Random(1)
    common = [(i, t) for t in (0, 1) for i in range(n)]
    rare = [(i, 2) for i in sorted(draw.sample(range(n), 30))]
    of, terms = (np.array(c, np.int32) for c in zip(*common, *rare))
    tfs = np.ones(len(of), np.int32)
    batch = search._shard_of(list(range(n)), np.full(n, 50), terms, tfs, of, n, 50 * n)
    shard, counts = search.opened_shard(batch.to_pylist()[0]), {}
    best = search.search_shard(shard, [(0, 1), (1, 1), (2, 9000)], 10, counts)
    assert sorted(p for p, _ in best) == [i for i, _ in rare[:10]]
    assert counts["opened"] < 0.5 * counts["blocks"]


@pytest.mark.parametrize("make", [odd_documents, clashing_documents])
def test_odd_documents(spark, make):
    docs = make(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, "one TWO three word5 ties"), (1, "one TWO three word5 ties"), (2, "日本語 naïve don't"), (None, "without id")]
    expected = brute_force(rows, list(dict.fromkeys(items)))
    assert found(docs, spark.createDataFrame(items, ITEMS)) == expected


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert found(no_documents(spark), spark.createDataFrame([(1, "x")], ITEMS)) == []
    assert found(odd_documents(spark), none) == []
