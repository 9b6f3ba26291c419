import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from shared import clashing_documents, no_documents, odd_documents, rows_of

from spendlight.llm import probminhash
from spendlight.llm.components import components, merged_components


def texts_with_copies():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(5000)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randrange(30, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            near = list(base)
            for _ in range(rng.randrange(1, 6)):
                near[rng.randrange(len(near))] = rng.choice(words)
            texts.append(" ".join(near))
    chain = [rng.choice(words) for _ in range(400)]
    for _ in range(30):  # a large bucket: every text is like the one before it
        chain = list(chain)
        chain[rng.randrange(400)] = rng.choice(words)
        texts.append(" ".join(chain))
    texts += [texts[0], texts[0], texts[3].upper() + "!"]
    return texts


def plain_shingles(text):
    """Weights by tuples of words."""
    words = re.findall(r"[^\W_]+", text.lower())
    size = min(probminhash.WORDS, len(words))
    counts = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else {}
    return {shingle: 1 + math.log(n) for shingle, n in counts.items()}


def plain_similarity(a, b):
    shared = a.keys() & b.keys()
    if not shared:
        return 0.0
    every = list(a.keys() | b.keys())
    x, y = (np.array([w.get(e, 0.0) for e in every]) for w in (a, b))
    return sum(1 / np.maximum(x / a[d], y / b[d]).sum() for d in shared)


def brute(texts):
    sets = [plain_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or plain_similarity(sets[i], sets[j]) >= probminhash.SIMILAR:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("small", [8, 2])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, small):
    monkeypatch.setattr(probminhash, "SMALL", small)
    texts = texts_with_copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in probminhash.near_duplicates(docs).collect()}
    expected = brute(texts)
    assert [found[i].class_id for i in range(len(texts))] == expected
    assert [found[i].kept for i in range(len(texts))] == [i == c for i, c in enumerate(expected)]
    kept = sorted(r.doc_id for r in probminhash.deduplicated(docs).collect())
    assert kept == sorted(set(expected))


@pytest.mark.parametrize("block, block_bytes", [(256, 1 << 22), (7, 1 << 22), (256, 900)])
def test_blocks_join_groups_that_the_first_text_of_a_bucket_leaves_apart(spark, monkeypatch, block, block_bytes):
    monkeypatch.setattr(probminhash, "BLOCK", block)
    monkeypatch.setattr(probminhash, "BLOCK_BYTES", block_bytes)
    texts = texts_with_copies()
    ids = list(range(len(texts)))
    bands = probminhash.bands_of(probminhash.signatures(texts)).tolist()
    rows = [(bucket, band, i, i) for i in ids for band, bucket in enumerate(bands[i])]
    members = spark.createDataFrame(rows, "bucket long, band int, node long, component long")
    docs = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    links = probminhash._joined_groups(members, docs)
    found = {r.node: r.component for r in components(links).collect()}
    assert [found.get(i, i) for i in ids] == brute(texts)


def test_exact_similarity():
    rng = np.random.default_rng(2)
    for _ in range(20):
        keys = np.arange(40, dtype=np.uint64)
        a = (np.sort(rng.choice(keys, 25, replace=False)), rng.integers(1, 5, 25).astype(float))
        b = (np.sort(rng.choice(keys, 30, replace=False)), rng.integers(1, 5, 30).astype(float))
        x, y = dict(zip(*a)), dict(zip(*b))
        every = set(x) | set(y)
        plain = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in set(x) & set(y))
        assert probminhash.probability_jaccard(a, b) == pytest.approx(plain)


def test_signatures_estimate_the_similarity():
    rng = random.Random(5)
    errors = []
    for _ in range(40):
        base = [f"w{rng.randrange(9999)}" for _ in range(200)]
        other = [w if rng.random() > 0.05 else "z" for w in base]
        texts = [" ".join(base + base[:50]), " ".join(other)]
        a, b = probminhash.signatures(texts)
        errors.append((a == b).mean() - probminhash.probability_jaccard(*probminhash._shingle_sets(texts)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = rows_of(probminhash.near_duplicates(docs))
    assert len(found) == 12
    assert sorted(r[2] for r in found if r[0] == 1) == [False, True]
    classes = {r[0]: r[1] for r in found if r[0] is not None}
    assert classes[4] == 3 and classes[9] == -8 and classes[2] == 2 and classes[5] == 5
    clashing = clashing_documents(spark)
    assert rows_of(probminhash.near_duplicates(clashing)) == found
    out = probminhash.deduplicated(clashing)
    assert out.columns == clashing.columns
    assert sorted(str(r[0]) for r in found if r[2]) == sorted(str(r.doc_id) for r in out.collect())
    assert probminhash.near_duplicates(no_documents(spark)).collect() == []
    assert probminhash.deduplicated(no_documents(spark)).collect() == []


@pytest.mark.parametrize("few", [0, 1 << 18])
def test_components_of_chains_stars_and_rings(spark, few):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, n) for n in range(101, 140)]
    links += [(n, n + 1) for n in range(200, 220)] + [(220, 200), (300, 300), (7, 3), (3, 7)]
    table = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components(table, few).collect()}
    nodes = [*range(61), *range(100, 140), *range(200, 221)]
    expected = {n: 0 if n <= 60 else 100 if n < 140 else 200 for n in nodes}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long"), few).collect() == []
    cut = [i for i in range(len(links)) if i % 3 == 0]
    first = components(table.sparkSession.createDataFrame([links[i] for i in cut], "a long, b long"), few)
    rest = [links[i] for i in range(len(links)) if i % 3]
    merged = merged_components(first, spark.createDataFrame(rest, "a long, b long"), few)
    assert {r.node: r.component for r in merged.collect()} == expected


def test_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "BLOCK_BYTES", 1 << 16)
    monkeypatch.setattr(probminhash, "SMALL", 2)
    rng = random.Random(8)
    base = [f"w{rng.randrange(99999)}" for _ in range(150_000)]
    texts = []
    for n in range(12):
        words = list(base)
        for at in rng.sample(range(len(words)), 1000 + n):
            words[at] = "z"
        texts.append(" ".join(words))
    texts += [" ".join(f"v{rng.randrange(99999)}" for _ in range(150_000)) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in probminhash.near_duplicates(docs).collect()}
    assert [found[i] for i in range(14)] == [0] * 12 + [12, 13]
